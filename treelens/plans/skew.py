"""A join whose hot keys are spread over many tasks, whatever the plan around it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from treelens.plans.materialize import materialize

HOT_SHARE = 1000  # a key with more than this part of the rows is hot, so there are fewer such keys
SALTS = 64


def left_join_spread(rows: DataFrame, index: DataFrame, keys: Sequence[str], spread: Sequence[str]) -> DataFrame:
    """``rows`` left joined with ``index``, which has one row per key.

    Keys are counted first. Rows of a hot key are dealt out by the hash of ``spread``, and its
    index row is there once for every part; so are rows without a key, which answer nothing.
    ``rows`` should be narrow: they are written once. The hot keys, fewer than ``HOT_SHARE``, are broadcast.
    """
    rows = materialize(rows)
    total = rows.count()
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = F.broadcast(materialize(counts.filter(F.col("_n") * HOT_SHARE > total).select(*keys, F.lit(True).alias("_hot"))))
    keyless = F.lit(False)
    for key in keys:
        keyless = keyless | F.col(key).isNull()
    part = F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")
    dealt = rows.join(hot, list(keys), "left").withColumn("_salt", F.when(F.coalesce("_hot", keyless), part).otherwise(F.lit(0))).drop("_hot")
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copied = index.join(hot, list(keys), "left").withColumn("_salt", F.explode(every)).drop("_hot")
    return dealt.join(copied, [*keys, "_salt"], "left").drop("_salt")
