"""Ordered per-group computations that never put a whole group in one task.

A group (one tree) may hold a large share of all rows, so no operator here uses
a window that is partitioned by the group alone:

* ``top_per_group`` ranks inside salted slices first, so the last window sees at
  most ``SALTS * (k + 1)`` rows of a group;
* ``running_totals`` range-partitions the rows, sums per range, and shifts each
  range by the total of the ranges before it;
* ``greedy_fill`` accepts rows in order while they fit, in a logarithmic number
  of ``running_totals`` passes for large groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from treelens.plans.materialize import materialize, small_side

SALTS = 32
TOP_LIMIT = 10_000  # larger k goes through running_totals
GREEDY_GROUP_ROWS = 100_000  # groups up to this size finish in one grouped fold


def display_order(df: DataFrame, *columns: str) -> DataFrame:
    """Rows sorted for reading: by tree, then text columns in locale order, numbers as numbers."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema}
    keys = [F.collate(c, "UNICODE") if kinds[c] == "string" else F.col(c) for c in columns]
    return df.orderBy("tree_id", *keys)


def _ranked(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str) -> DataFrame:
    window = Window.partitionBy(*by).orderBy(*order)
    # The filter must see the bare row_number: then each task keeps only k rows before the shuffle.
    kept = df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
    return kept.withColumn(rank, F.col(rank).cast("bigint"))


def top_per_group(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    k: int,
    salt: Sequence[str],
    rank: str = "rank",
    overflow: str | None = None,
) -> DataFrame:
    """First ``k`` rows of each group in ``order``, numbered from 1 in ``rank``.

    ``order`` must be total within a group and ``salt`` must name columns that
    spread its rows. ``overflow`` names a flag that is true only when the group
    holds at least one row more than ``k``.
    """
    keep = k + 1 if overflow else k
    if keep > TOP_LIMIT:
        top = running_totals(df, by, order, {rank: F.lit(1)}).filter(F.col(rank) <= keep)
        if overflow is None:
            return top
        # One row of each group that holds more is enough to flag the others.
        top = materialize(top)
        more = small_side(top.filter(F.col(rank) == keep).select(*by, F.lit(True).alias(overflow)))
        flagged = top.filter(F.col(rank) <= k).join(more, list(by), "left")
        return flagged.withColumn(overflow, F.coalesce(F.col(overflow), F.lit(False)))
    else:
        sliced = df.withColumn("_salt", F.pmod(F.xxhash64(*salt), F.lit(SALTS)))
        sliced = _ranked(sliced, [*by, "_salt"], order, keep, "_slice_rank")
        top = _ranked(sliced.drop("_salt", "_slice_rank"), by, order, keep, rank)
    if overflow is None:
        return top
    # The group is already cut to k + 1 rows, at most TOP_LIMIT, so this window is small.
    more = F.max(rank).over(Window.partitionBy(*by)) > k
    return top.withColumn(overflow, more).filter(F.col(rank) <= k)


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    weights: dict[str, Column],
) -> DataFrame:
    """Add inclusive running sums of ``weights`` per group in ``order``.

    ``df`` should be narrow (keys and numbers). Its rows are range-partitioned by
    group and order and written once, which fixes the range number of each row.
    """
    values = df.select("*", *(w.cast("bigint").alias(name) for name, w in weights.items()))
    ranged = materialize(
        values.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id())
    )
    totals = ranged.groupBy(*by, "_range").agg(*(F.sum(n).alias(n) for n in weights))
    # One row per group and range: at most as many as there are partitions.
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_range", *(F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}") for n in weights)
    )
    upto = Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = ranged.join(offsets, [*by, "_range"])
    return joined.select(
        *df.columns,
        *((F.sum(n).over(upto) + F.col(f"_before_{n}")).alias(n) for n in weights),
    )


def greedy_fill(
    df: DataFrame,
    by: str,
    order: Sequence[Column],
    size: str,
    budget: int,
    group_rows: int = GREEDY_GROUP_ROWS,
) -> DataFrame:
    """Rows that fit when each group takes rows in order and skips what does not fit.

    The room left only shrinks. While it lies in [2^e, 2^(e+1)), rows smaller than
    2^e always fit and at most one larger row can; so the first event that moves
    the room below 2^e follows from a running sum, and every pass at least halves
    the room. When all rows left are smaller than that, the pass goes on until the
    largest of them might not fit, which covers a large budget in one pass. Groups
    with few rows left skip the passes and finish in one fold over at most
    ``group_rows`` rows.
    """
    rows = df.filter(F.col(size) <= budget)
    rows = materialize(running_totals(rows, [by], order, {"_pos": F.lit(1)}))
    state = small_side(rows.select(by).distinct()).select(
        by, F.lit(budget).cast("bigint").alias("_room"), F.lit(0).cast("bigint").alias("_done")
    )
    accepted: list[DataFrame] = []
    while True:
        todo = rows.join(state, by).filter((F.col("_pos") > F.col("_done")) & (F.col(size) <= F.col("_room")))
        counts = todo.groupBy(by).agg(F.count("*").alias("_left"), F.max(size).alias("_top"))
        large = counts.filter(F.col("_left") > group_rows).select(by, "_top")
        large = small_side(large)
        accepted.append(_fold_groups(todo.join(large, by, "left_anti").drop("_done"), by, size))
        if large.isEmpty():
            break
        # One pass for the large groups; the others are done by the fold.
        half = F.least(_power_of_two_below("_room"), F.col("_top") + 1)
        part = todo.join(large, by).withColumn("_half", half).drop("_top")
        small = (F.col(size) == 0) | (F.col(size) < F.col("_half"))
        part = running_totals(part, [by], [F.col("_pos")], {"_sum": F.when(small, F.col(size)).otherwise(0)})
        part = materialize(part)
        after = F.col("_room") - F.col("_sum") - F.when(small, F.lit(0)).otherwise(F.col(size))
        event = (after >= 0) & (after < F.col("_half"))
        cut = part.filter(event).groupBy(by).agg(
            F.min("_pos").alias("_cut"), F.min_by(after, "_pos").alias("_new_room")
        )
        cut = small_side(cut)
        seen = part.join(cut, by, "left")
        taken = F.col("_cut").isNull() & small
        taken = taken | (F.col("_cut").isNotNull() & small & (F.col("_pos") <= F.col("_cut")))
        taken = taken | F.coalesce(F.col("_pos") == F.col("_cut"), F.lit(False))
        accepted.append(materialize(seen.filter(taken).select(*df.columns)))
        state = cut.select(by, F.col("_new_room").alias("_room"), F.col("_cut").alias("_done"))
    out = accepted[0].select(*df.columns)
    for more in accepted[1:]:
        out = out.unionByName(more.select(*df.columns))
    return out


def _power_of_two_below(name: str) -> Column:
    # Length of the binary form, so no rounding of logarithms is involved.
    bits = F.length(F.bin(name)) - 1
    return F.when(F.col(name) < 1, F.lit(0)).otherwise(F.call_function("shiftleft", F.lit(1).cast("bigint"), bits))


def _fold_groups(df: DataFrame, by: str, size: str) -> DataFrame:
    """Greedy fold per group; every group is known to be small."""

    def fold(frame):
        frame = frame.sort_values("_pos")
        room, keep = int(frame["_room"].iloc[0]), []
        for need in frame[size]:
            fits = need <= room
            room -= need if fits else 0
            keep.append(fits)
        return frame[keep]

    return df.groupBy(by).applyInPandas(fold, df.schema)
