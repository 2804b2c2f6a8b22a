"""The end of a budgeted scan as one row per tree, applied to contents without shuffling them."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from treelens.functions import paths as P
from treelens.operators.inventory import KEY
from treelens.plans.materialize import measured, small_side

_ALL_LINES = 1 << 30


class Cuts(NamedTuple):
    """Where a budgeted scan ends, as one row per tree; files are those before the cut.

    ``trees``: tree_id, cut_path and cut_lines (the last file in path order and its leading lines),
    first_path and first_lines (a file read before all others). ``skipped``: files before the cut
    that are not read. ``granted``: the same scan as rows per file, for corpora of so many trees
    that their cuts are no longer broadcast.
    """

    trees: DataFrame
    skipped: DataFrame
    granted: DataFrame


def cuts_of(granted: DataFrame, passed: DataFrame) -> Cuts:
    """Cuts of ``granted(tree_id, path, granted_lines[, first])``; ``passed`` are narrow rows of files that may lie before them."""
    first = F.col("first") if "first" in granted.columns else F.lit(False)
    order = F.struct(P.locale_key("path"), F.col("path"))
    file = F.struct("path", F.col("granted_lines").cast("bigint").alias("lines"))
    trees = granted.groupBy("tree_id").agg(
        F.max_by(F.when(~first, file), F.when(~first, order)).alias("cut"), F.max(F.when(first, file)).alias("lead")
    )
    trees = trees.select(
        "tree_id", F.col("cut.path").alias("cut_path"), F.col("cut.lines").alias("cut_lines"),
        F.col("lead.path").alias("first_path"), F.col("lead.lines").alias("first_lines"),
    )
    skipped = passed.join(trees, "tree_id").filter(_until_cut()).select(*KEY).join(granted.select(*KEY), KEY, "left_anti")
    return Cuts(trees, skipped, granted.select(*KEY, "granted_lines"))


def _until_cut() -> Column:
    here, cut = P.locale_key("path"), P.locale_key("cut_path")
    return (here < cut) | ((here == cut) & (F.col("path") <= F.col("cut_path")))


def within_cuts(files: DataFrame, cuts: Cuts) -> DataFrame:
    """The files a budgeted scan reads, with ``granted_lines``; their contents are not shuffled.

    Cuts and skipped files are broadcast up to their measured limit. Beyond it the granted files
    are joined by ``(tree_id, path)``, which leaves a table of ``write_corpus`` in place.
    """
    trees, few = measured(cuts.trees)
    if few:
        skipped, few = measured(cuts.skipped)
    if not few:
        return files.join(small_side(cuts.granted), KEY)
    rows = files.join(F.broadcast(trees), "tree_id").join(F.broadcast(skipped), KEY, "left_anti")
    lead = F.coalesce(F.col("path") == F.col("first_path"), F.lit(False))
    lines = F.when(lead, F.col("first_lines")).when(F.col("path") == F.col("cut_path"), F.col("cut_lines")).otherwise(F.lit(_ALL_LINES))
    inside = rows.filter(lead | F.coalesce(_until_cut(), F.lit(False)))
    return inside.withColumn("granted_lines", lines.cast("bigint")).drop("cut_path", "cut_lines", "first_path", "first_lines")
