"""Coverage of scans that stop: symbols, related files and batch reads, one row per tree or batch.

A scan is an ordered pass over files, each of which is an event: read, too large, over the
bytes left, refused, or in a language that is not scanned. Where the pass stops follows from
running totals over narrow rows; the events up to there are folded into counters, flags,
reasons and the language map. Contents are read once, for the facts of files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from treelens import constants as K
from treelens.functions import paths as P, text as T
from treelens.functions.policy import DEFAULT_POLICY, Policy
from treelens.operators.budgets import budgeted_imports, budgeted_symbols, byte_greedy
from treelens.operators.coverage import finish, with_language_map
from treelens.operators.inventory import KEY, before_cut, fits, inventory_coverage, kept, path_filter, walk_cut
from treelens.operators.reading import served_batch
from treelens.operators.related import related
from treelens.plans.materialize import materialize, small_side
from treelens.plans.ordered import running_totals


def _events(files: DataFrame, c: DataFrame, languages, max_bytes_per_file, max_total_bytes) -> DataFrame:
    """Narrow rows of files with what a scan meets in each: ``scans`` (the language counts), ``small``, ``fits``, ``refusal``, ``n_lines``."""
    scans = F.coalesce(P.language("path").isin(*languages), F.lit(False))
    if "first" in files.columns:
        scans = scans | F.col("first")
    small = fits(c, max_bytes_per_file)
    reads = scans & small
    refusal = T.refusal("content", T.is_binary(c))
    facts = files.select(
        *(n for n in (*KEY, "size", "first") if n in files.columns),
        P.language("path").alias("language"), scans.alias("scans"), small.alias("small"),
        F.when(reads, refusal).alias("refusal"),
        F.when(reads & refusal.isNull(), T.line_count(T.decoded("content"))).otherwise(F.lit(0)).cast("bigint").alias("n_lines"),
    )
    facts = materialize(facts)  # one pass over the contents; the rest is narrow
    if max_total_bytes is None:
        return facts.withColumn("fits", F.lit(True))
    taken = byte_greedy(facts.filter("scans and small"), max_total_bytes).select(*KEY, F.lit(True).alias("fits"))
    return facts.join(taken, KEY, "left").withColumn("fits", F.coalesce("fits", F.lit(False)))


def _passed(events: DataFrame, max_total_lines: int | None, found: DataFrame | None = None, max_found: int | None = None) -> DataFrame:
    """The events a pass meets, with ``line_stop`` and ``found_stop``.

    The pass ends before the file that finds no lines left, and after the one whose lines are
    cut or that holds one result too many. ``found(tree_id, path, n_found)`` counts results.
    """
    read = F.col("scans") & F.col("small") & F.col("fits") & F.col("refusal").isNull()
    rows = events.withColumn("read", read).withColumn("n_lines", F.when(read, F.col("n_lines")).otherwise(F.lit(0)).cast("bigint"))
    if max_found is None:
        rows = rows.withColumn("n_found", F.lit(0).cast("bigint"))
    else:
        rows = rows.join(found, KEY, "left").withColumn("n_found", F.coalesce("n_found", F.lit(0)).cast("bigint"))
    order = [P.locale_key("path"), F.col("path")]
    if "first" in rows.columns:
        order = [~F.col("first"), *order]
    rows = materialize(running_totals(rows, ["tree_id"], order, {"pos": F.lit(1), "lines_upto": F.col("n_lines"), "found_upto": F.col("n_found")}))
    never = F.lit(False)
    no_lines = never if max_total_lines is None else F.col("scans") & (F.col("lines_upto") - F.col("n_lines") >= max_total_lines)
    cut_lines = never if max_total_lines is None else (F.col("n_lines") > 0) & (F.col("lines_upto") > max_total_lines)
    over = never if max_found is None else (F.col("n_found") > 0) & (F.col("found_upto") > max_found)
    ends = rows.groupBy("tree_id").agg(
        F.min(F.when(no_lines, F.col("pos") - 1)).alias("end_before"), F.min(F.when(cut_lines | over, F.col("pos"))).alias("end_after")
    )
    rows = rows.join(small_side(ends), "tree_id")
    end = F.least("end_before", "end_after")
    # Only a file that was really looked at can be the one that found no lines left.
    looked_at = F.col("end_after").isNull() | (F.col("end_before") < F.col("end_after"))
    stopper = F.coalesce((F.col("pos") == F.col("end_before") + 1) & looked_at, never)
    inside = end.isNull() | (F.col("pos") <= end)
    rows = rows.select("*", inside.alias("inside"), stopper.alias("stopper"))
    return rows.filter("inside or stopper").select(
        *(n for n in (*events.columns, "read") if n != "fits"), "fits", "inside",
        (F.col("stopper") | (F.col("inside") & cut_lines)).alias("line_stop"), (F.col("inside") & over).alias("found_stop"),
    )


def _counts() -> dict[str, Column]:
    inside = F.col("inside")
    scans = inside & F.col("scans")
    return {
        "scanned_files": F.count_if(inside & F.col("read")),
        "bytes_scanned": F.sum(F.when(inside & F.col("read"), F.col("size")).otherwise(F.lit(0))),
        "skipped_unreadable": F.count_if(scans & F.col("small") & F.col("fits") & F.col("refusal").isNotNull()),
        "too_large": F.count_if(scans & ~F.col("small")),
        "over_bytes": F.count_if(scans & F.col("small") & ~F.col("fits")),
        "line_limit_reached": F.bool_or("line_stop"),
        "found_stop": F.bool_or("found_stop"),
    }


def _report(walk: DataFrame, scan: DataFrame, flag: str, reason: str) -> DataFrame:
    """Coverage of the walk and the folded events of the scan. A file too large is no count here, only a limit met."""
    rows = walk.join(scan, "tree_id", "left")
    met = lambda name: F.coalesce(F.col(name) > 0, F.lit(False))
    large, over = met("too_large"), met("over_bytes")
    rows = rows.withColumn(flag, F.coalesce("found_stop", F.lit(False))).withColumn("byte_limit_reached", large | over)
    reasons = F.array(
        F.col("reason"), F.when(large, "maxBytesPerFile"), F.when(over, "maxTotalBytes"),
        F.when(F.col("line_limit_reached"), "maxTotalLines"), F.when(F.col(flag), reason),
    )
    return finish(rows, reasons)


def symbols_coverage(
    c: DataFrame,
    policy: Policy = DEFAULT_POLICY,
    max_files: int | None = None,
    max_directories: int | None = None,
    max_bytes_per_file: int | None = None,
    max_total_bytes: int | None = None,
    max_total_lines: int | None = None,
    max_symbols: int | None = None,
    kind: str | None = None,
    query: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Coverage of ``budgeted_symbols`` with the same limits, with the map of languages it passed over.

    Files are visited in path order until lines or symbols run out; what lies after that is in
    no counter, and its languages are not in the map.
    """
    walk = inventory_coverage(c, policy, max_files, max_directories, path=path)
    files = kept(c, policy).filter(path_filter(path))
    if max_files is not None or max_directories is not None:
        files = before_cut(files, walk_cut(c, policy, max_files, max_directories, path=path))
    events = _events(files, c, K.SYMBOL_LANGUAGES, max_bytes_per_file, max_total_bytes)
    found = None
    if max_symbols is not None:
        hits = budgeted_symbols(files, max_total_bytes, max_total_lines, policy, max_bytes_per_file, kind=kind, query=query)
        found = hits.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_found"))
    rows = _passed(events, max_total_lines, found, max_symbols)
    scan = rows.groupBy("tree_id").agg(*(v.alias(k) for k, v in _counts().items()))
    passed = rows.filter("inside and not scans").groupBy("tree_id", "language").agg(F.count(F.lit(1)).alias("files"))
    return with_language_map(_report(walk, scan, "symbol_limit_reached", "maxSymbols"), passed)


def related_coverage(
    c: DataFrame,
    targets: DataFrame,
    policy: Policy = DEFAULT_POLICY,
    max_files: int | None = None,
    max_directories: int | None = None,
    max_bytes_per_file: int | None = None,
    max_total_bytes: int | None = None,
    max_total_lines: int | None = None,
    max_relationships: int | None = None,
    **filters,
) -> DataFrame:
    """Coverage of ``related`` over ``budgeted_imports``, one target per tree, which is read first.

    ``scanned_import_files`` counts the files whose imports were looked for. A target in a
    language without imports spends bytes and is no scanned file. ``filters`` are those of
    ``related``; they decide how many relations count.
    """
    walk = inventory_coverage(c, policy, max_files, max_directories)
    wanted = small_side(targets.select(*KEY, F.lit(True).alias("first")))
    files = kept(c, policy)
    if max_files is not None or max_directories is not None:
        # The target is read whether or not the walk comes to it.
        inside = before_cut(files, walk_cut(c, policy, max_files, max_directories))
        files = inside.unionByName(files.join(wanted.select(*KEY), KEY, "left_semi").join(inside.select(*KEY), KEY, "left_anti"))
    marked = files.join(wanted, KEY, "left").withColumn("first", F.coalesce("first", F.lit(False)))
    events = _events(marked, c, K.IMPORT_LANGUAGES, max_bytes_per_file, max_total_bytes)
    script = F.coalesce(F.col("language").isin(*K.IMPORT_LANGUAGES), F.lit(False))
    # A target without imports is read like a refused file, but is nothing that was skipped.
    other = F.col("first") & ~script
    events = events.withColumn("scans", F.col("scans") & ~other).withColumn("n_lines", F.when(other, F.lit(0)).otherwise(F.col("n_lines")))
    rows = _passed(events, max_total_lines)
    scan = rows.groupBy("tree_id").agg(*(v.alias(k) for k, v in _counts().items() if k != "found_stop"))
    if max_relationships is None:
        scan = scan.withColumn("found_stop", F.lit(False))
    else:
        edges = budgeted_imports(files, targets, max_total_bytes, max_total_lines, policy, max_bytes_per_file)
        found = related(files, targets, max_per_target=max_relationships, policy=policy, edges=edges, **filters)
        scan = scan.join(found.groupBy("tree_id").agg(F.bool_or("relationship_limit_reached").alias("found_stop")), "tree_id", "left")
    report = _report(walk, scan, "relationship_limit_reached", "maxRelationships")
    return report.withColumn("scanned_import_files", F.col("scanned_files"))


def batch_coverage(c: DataFrame, requests: DataFrame, **limits) -> DataFrame:
    """Coverage of every batch of ``read_batch`` with the same arguments, one row per ``batch_id``.

    Ranges count, not files: two ranges of a file are two scans. A hash that differs is an
    answer and no gap in the coverage.
    """
    rows = served_batch(c, requests, **limits)
    ok, status = F.col("status") == "ok", F.col("status")
    gone = ~status.isin("ok", "hash-mismatch", "byte-limit-reached", "line-limit-reached")
    folded = rows.groupBy("batch_id").agg(
        F.count_if(ok).alias("scanned_files"),
        F.sum(F.when(ok, F.col("size")).otherwise(F.lit(0))).alias("bytes_scanned"),
        F.count_if(gone).alias("skipped_unreadable"),
        F.bool_or("result_limit_reached").alias("result_limit_reached"),
        F.bool_or("line_limit_reached").alias("line_limit_reached"),
        F.bool_or(status == "byte-limit-reached").alias("byte_limit_reached"),
        F.collect_set("limit").alias("limits"),  # two names at most
    )
    reasons = F.concat("limits", F.array(F.when(F.col("result_limit_reached"), "maxBatchRanges"), F.when(F.col("line_limit_reached"), "maxTotalLines")))
    return finish(folded.withColumnRenamed("batch_id", "tree_id"), reasons).withColumnRenamed("tree_id", "batch_id")
