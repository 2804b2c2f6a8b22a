"""A bounded set of keys as a row filter, for scans that must not shuffle their contents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

BITS = 24


def key_filter(keys: DataFrame, *columns: str, bits: int = BITS) -> Callable[..., Column]:
    """A predicate that holds for all rows of ``keys``, and for few others.

    The keys are hashed into 2**bits bits (2 MB by default), whatever their number. The
    bits come to the scan as one value of a scalar subquery, so the rows that are tested are
    neither joined nor shuffled. It answers "maybe" or "no"; an exact join has to follow.
    """
    words = 1 << (bits - 6)

    def place(*values) -> Column:
        return F.xxhash64(*values).bitwiseAND(F.lit((1 << bits) - 1))

    at = place(*columns)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))
    found = keys.select(F.shiftright(at, 6).alias("word"), one.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bit"))
    every = keys.sparkSession.range(words).withColumnRenamed("id", "word").join(found, "word", "left")
    # One row per word, of which there are always as many: the list has a fixed size.
    listed = F.array_sort(F.collect_list(F.struct("word", F.coalesce("bit", F.lit(0).cast("bigint")).alias("bit"))))
    table = every.agg(F.transform(listed, lambda w: w["bit"]).alias("bits")).scalar()

    def maybe(*values) -> Column:
        at = place(*values)
        word = F.get(table, F.shiftright(at, 6).cast("int"))
        return F.call_function("bit_get", word, at.bitwiseAND(F.lit(63)).cast("int")) == 1

    return maybe
