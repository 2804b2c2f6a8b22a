"""Coverage reports: what a scan saw, skipped and cut, one row per tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from treelens import constants as K
from treelens.functions import text as T
from treelens.functions.policy import DEFAULT_POLICY, Policy
from treelens.operators.inventory import fits, inventory_coverage, kept, path_filter
from treelens.operators.symbols import unsupported_languages


def finish(rows: DataFrame, reasons: Column, extra: list[str] = ()) -> DataFrame:
    """Fill absent counters and flags, derive ``partial`` and sort the reasons.

    Clipped excerpts and context do not make a report partial.
    """

    def counter(name):
        parts = [name, "skipped_links"] if name == "skipped_unreadable" else [name]
        return sum((F.coalesce(F.col(p), F.lit(0)) for p in parts if p in rows.columns), F.lit(0)).cast("bigint")

    def flag(name):
        return F.coalesce(F.col(name), F.lit(False)) if name in rows.columns else F.lit(False)

    limited = F.lit(False)
    for name in K.PARTIAL_FLAGS:
        limited = limited | flag(name)
    partial = (counter("skipped_large") > 0) | (counter("skipped_unreadable") > 0) | limited
    flags = [flag(n).alias(n) for n in K.FLAGS if n != "coverage_partial"]
    return rows.select(
        "tree_id",
        *(counter(n).alias(n) for n in K.COUNTERS),
        *flags,
        partial.alias("coverage_partial"),
        F.array_sort(F.array_distinct(F.array_compact(reasons))).alias("reasons"),
        partial.alias("partial"),
        *extra,
    )


def _walk(c, policy, limits, filters) -> DataFrame:
    walk = {k: limits.get(k) for k in ("max_files", "max_directories")}
    return inventory_coverage(c, policy, **walk, **filters)


def files_coverage(c: DataFrame, policy: Policy = DEFAULT_POLICY, max_files=None, max_directories=None, **filters) -> DataFrame:
    """Coverage of an inventory call."""
    rows = _walk(c, policy, {"max_files": max_files, "max_directories": max_directories}, filters)
    return finish(rows, F.array("reason"))


def read_coverage(c: DataFrame, policy: Policy = DEFAULT_POLICY, max_bytes_per_file: int | None = None, **filters) -> DataFrame:
    """Coverage of a full scan: every kept file is read unless it is too large or refused."""
    files = kept(c, policy).filter(path_filter(**filters))
    small = fits(c, max_bytes_per_file)
    refused = F.when(small, T.refusal("content", T.is_binary(c)).isNotNull()).otherwise(False)
    facts = files.select("tree_id", "size", small.alias("small"), refused.alias("refused"))
    scanned = F.col("small") & ~F.col("refused")
    counts = facts.groupBy("tree_id").agg(
        F.count_if(scanned).alias("scanned_files"),
        F.sum(F.when(scanned, F.col("size")).otherwise(0)).alias("bytes_scanned"),
        F.count_if(~F.col("small")).alias("skipped_large"),
        F.count_if(F.col("refused")).alias("skipped_unreadable"),
    )
    rows = _walk(c, policy, {}, filters).join(counts, "tree_id", "left")
    rows = rows.withColumn("byte_limit_reached", F.coalesce(F.col("skipped_large"), F.lit(0)) > 0)
    return finish(rows, F.array(F.col("reason"), F.when(F.col("byte_limit_reached"), "maxBytesPerFile")))


def search_coverage(
    c: DataFrame,
    plan: DataFrame,
    matches: DataFrame,
    policy: Policy = DEFAULT_POLICY,
    max_files=None,
    max_directories=None,
    **filters,
) -> DataFrame:
    """Coverage of a budgeted search from its ``scan_plan`` and returned matches."""
    walk = _walk(c, policy, {"max_files": max_files, "max_directories": max_directories}, filters)
    reached = F.col("reached")
    scan = plan.groupBy("tree_id").agg(
        F.count_if("scanned").alias("scanned_files"),
        F.sum(F.when(F.col("scanned"), F.col("size")).otherwise(0)).alias("bytes_scanned"),
        F.count_if(reached & ~F.col("small")).alias("skipped_large"),
        F.count_if(reached & F.col("small") & F.col("refusal").isNotNull()).alias("skipped_unreadable"),
        F.bool_or("byte_stop").alias("byte_stop"),
        F.bool_or("line_stop").alias("line_limit_reached"),
    )
    clipped = {"excerpt_truncated": F.bool_or("text_truncated")}
    for side in ("before", "after"):
        if f"context_{side}" in matches.columns:
            long_line = F.exists(f"context_{side}", lambda line: line["text_truncated"])
            clipped[f"context_{side}_truncated"] = F.bool_or(long_line)
    if "match_limit_reached" in matches.columns:
        clipped["match_limit_reached"] = F.bool_or("match_limit_reached")
    found = matches.groupBy("tree_id").agg(*(v.alias(k) for k, v in clipped.items()))
    rows = walk.join(scan, "tree_id", "left").join(found, "tree_id", "left")
    large = F.coalesce(F.col("skipped_large"), F.lit(0)) > 0
    rows = rows.withColumn("byte_limit_reached", large | F.coalesce("byte_stop", F.lit(False)))
    names = {"line_limit_reached": "maxTotalLines", "match_limit_reached": "maxMatches", "excerpt_truncated": "excerptTruncated",
             "context_before_truncated": "contextBeforeTruncated", "context_after_truncated": "contextAfterTruncated"}
    reasons = [F.col("reason"), F.when(large, "maxBytesPerFile"), F.when(F.col("byte_stop"), "maxTotalBytes")]
    reasons += [F.when(F.col(flag), text) for flag, text in names.items() if flag in rows.columns]
    return finish(rows, F.array(*reasons))


def with_unsupported(coverage: DataFrame, c: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Adds the map language -> files without symbol patterns."""
    return with_language_map(coverage, unsupported_languages(c, policy))


def with_language_map(coverage: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds the map ``unsupported_languages`` of ``counts(tree_id, language, files)``."""
    # One row per tree and language; languages are a fixed short list.
    counts = counts.groupBy("tree_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("language", "files")))).alias("unsupported_languages")
    )
    empty = F.create_map().cast("map<string,bigint>")
    return coverage.join(counts, "tree_id", "left").withColumn("unsupported_languages", F.coalesce("unsupported_languages", empty))


def merge_coverage(*reports: DataFrame) -> DataFrame:
    """Add counters, OR flags and unite reasons of several reports per tree.

    Where a report has the map of ``with_unsupported``, so has the result: its counts are added too.
    """
    mapped = any("unsupported_languages" in r.columns for r in reports)
    rows = reports[0]
    for report in reports[1:]:
        rows = rows.unionByName(report, allowMissingColumns=mapped)
    flags = [n for n in K.FLAGS if n != "coverage_partial"]
    # Reasons come from a fixed short list, so the set per tree stays small.
    merged = rows.groupBy("tree_id").agg(
        *(F.sum(n).alias(n) for n in K.COUNTERS),
        *(F.bool_or(n).alias(n) for n in flags),
        F.flatten(F.collect_set("reasons")).alias("all_reasons"),
    )
    if not mapped:
        return finish(merged, F.col("all_reasons"))
    counts = rows.select("tree_id", F.explode("unsupported_languages").alias("language", "files"))
    counts = counts.groupBy("tree_id", "language").agg(F.sum("files").alias("files"))
    return with_language_map(finish(merged, F.col("all_reasons")), counts)
