
from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

import oracles  # noqa: E402
import treelens as tl  # noqa: E402
from treelens.functions import paths as P, text as T  # noqa: E402
from treelens.sources.corpus import code_files, conversations, documents, moderated_code_files, pages, varied_files  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]


def _llm() -> tuple[dict, dict]:
    """Queries and SQL of the training-data package and its pipeline, if they are there."""
    found, sql = {}, {}
    try:
        from treelens.llm.queries import ORACLES, QUERIES
    except ModuleNotFoundError as missing:
        if missing.name not in ("treelens.llm", "treelens.llm.queries"):
            raise
        return found, sql
    found |= QUERIES
    sql |= ORACLES
    try:
        import corpus_pipeline
    except ModuleNotFoundError as missing:
        if missing.name != "corpus_pipeline":
            raise
        return found, sql
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql

MATCH = ["tree_id", "path", "line", "text", "text_truncated", "file_sha256", "bytes"]
SYMBOL = ["tree_id", "path", "line", "language", "kind", "name", "signature", "confidence", "extractor", "source_sha256"]
SEARCH_LIMITS = dict(max_bytes_per_file=3000, max_total_bytes=20000, max_total_lines=200, max_matches=60)
COVERAGE_LIMIT = 5000


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: classified kept files joined into a literal search of all trees."""
    c = code_files(spark, "/root/testdata/sf0.001")
    hits = tl.search(c, "the")
    return hits.select(*MATCH, P.language("path").alias("language"), P.role("path").alias("role"))


def _on_code(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(code_files(spark, sf_dir))


def _scopes(c: DataFrame) -> DataFrame:
    """What a caller may name in every tree."""
    named = ["src", "src/mod0.ts", ".", "./docs/../lib", "gone", "src/mod", "conf/env7/.env", ".ssh/key", "node_modules/pkg6", "../x", "/src"]
    return c.select("tree_id").distinct().select("tree_id", F.explode(F.array(*map(F.lit, named))).alias("path"))


def _unsupported(c: DataFrame) -> DataFrame:
    rows = _with_reasons(tl.with_unsupported(tl.files_coverage(c), c))
    return rows.withColumn("unsupported_languages", _counts("unsupported_languages"))


def _counts(name: str):
    return F.array_join(F.transform(F.array_sort(F.map_entries(name)), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")


def _outline_report(c: DataFrame) -> DataFrame:
    rows = tl.outline_report(c, max_files=15, max_directories=7, sample=10)
    facts = [F.col(f"snapshot.{n}") for n in ("fingerprint_kind", "fingerprint_scope", "complete")]
    facts += [F.col(f"coverage.{n}") for n in ("candidate_files", "skipped_secret", "skipped_generated", "partial")]
    paths = F.array_join(F.transform("files_sample", lambda x: x["path"]), ",").alias("sample")
    return rows.select("tree_id", "fingerprint", paths, "inventory_limit_reached", *facts, _joined("coverage.reasons").alias("reasons"))


def _map_report(c: DataFrame) -> DataFrame:
    rows = tl.map_report(c, max_listed_symbols=6, **LEDGER_LIMITS)
    facts = [F.col(f"coverage.{n}") for n in ("scanned_files", "bytes_scanned", "line_limit_reached", "symbol_limit_reached", "byte_limit_reached", "partial")]
    names = F.array_join(F.transform("symbols", lambda x: F.concat_ws(":", x["path"], x["line"].cast("string"), x["name"])), ",").alias("symbols")
    return rows.select(
        "tree_id", "total_files", "symbol_fingerprint", "symbols_limit_reached", F.col("snapshot.fingerprint").alias("fingerprint"),
        F.col("snapshot.complete").alias("complete"), names, *facts, _joined("coverage.reasons").alias("reasons"),
        _counts("coverage.unsupported_languages").alias("unsupported_languages"),
    )


def _map_flags(c: DataFrame) -> DataFrame:
    rows = tl.corpus_map(c, max_listed_files=40, max_listed_directories=30, max_listed_per_role=4, max_listed_symbols=45)
    flags = [f"{n}_limit_reached" for n in ("files", "directories", "symbols", "manifests", "ci", "docs", "tests")]
    return rows.select("tree_id", "total_files", *flags, *(F.size(n).cast("bigint").alias(f"n_{n}") for n in ("files", "manifests", "ci", "docs", "tests", "symbols")))


def _on_varied(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(varied_files(spark, sf_dir))


def _joined(column: str):
    return F.array_join(column, ",")


def _with_reasons(report: DataFrame) -> DataFrame:
    return report.withColumn("reasons", _joined("reasons"))


def _classified(c: DataFrame) -> DataFrame:
    return c.select(
        "tree_id", "path", "size", P.basename("path").alias("basename"), P.dirname("path").alias("directory"),
        P.extension("path").alias("extension"), P.stem("path").alias("stem"), P.test_stem("path").alias("test_stem"),
        P.language("path").alias("language"), P.role("path").alias("role"),
    )


def _relative(c: DataFrame) -> DataFrame:
    root = F.concat(F.lit("/data/trees/"), "tree_id")
    location = F.concat(root, F.lit("/"), "path")
    return c.select("tree_id", P.relativize(location, root).alias("relative"), location.alias("location"))


def _path_requests(c: DataFrame) -> DataFrame:
    p = F.col("path")
    shapes = [p, F.concat(F.lit("/"), p), F.concat(F.lit("./"), p), F.concat(F.lit("../"), p), F.concat(p, F.lit("/../x")),
              F.concat(F.lit("../../"), p, F.lit("/../..")), F.concat(p, F.lit("/"))]
    return tl.validate_paths(c.select("tree_id", F.explode(F.array(*shapes)).alias("path")))


def _range_requests(c: DataFrame, expected=None) -> DataFrame:
    """One request per file, secret and generated files included."""
    return c.select(
        F.col("doc_id").alias("request_id"), "tree_id", "path", (F.length("path") % 7).alias("start_line"),
        (F.col("size") % 9 + 1).alias("max_lines"),
        *([] if expected is None else [expected.alias("expected_sha256")]),
    )


def _hash_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = code_files(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.upper(F.sha2("text", 256)).alias("sha"))
    return tl.read_ranges(c, _range_requests(c.drop("content").join(docs, "doc_id"), F.col("sha")))


BATCH_LIMITS = dict(max_ranges=20, max_total_lines=60, max_total_bytes=20000)
LEDGER_LIMITS = dict(max_bytes_per_file=3000, max_total_bytes=20000, max_total_lines=60)


def _batch_requests(c: DataFrame) -> DataFrame:
    return _range_requests(c).withColumn("batch_id", F.col("tree_id")).withColumn("seq", F.col("request_id"))


def _batch(c: DataFrame) -> DataFrame:
    rank = F.row_number().over(tl_window("batch_id", "seq"))
    answers = tl.read_batch(c, _batch_requests(c), **BATCH_LIMITS)
    return answers.withColumn("seq", rank.cast("bigint")).drop("batch_id")


def tl_window(by: str, order: str):
    from pyspark.sql import Window

    return Window.partitionBy(by).orderBy(order)  # batches hold at most 20 rows


def _range_prints(c: DataFrame) -> DataFrame:
    answers = tl.read_ranges(c, _range_requests(c)).filter(F.col("status") == "ok")
    return tl.fingerprint_of_hashes(answers.select("tree_id", "path", "sha256", F.concat_ws("-", "start_line", "end_line").alias("range")))


def _context(c: DataFrame) -> DataFrame:
    def flat(name):
        return F.array_join(F.transform(name, lambda x: F.concat(x["line"].cast("string"), F.lit(":"), x["text"])), "\n")

    rows = tl.search(c, "license", context=2)
    return rows.select(*MATCH, flat("context_before").alias("context_before"), flat("context_after").alias("context_after"))


def _talk_prints(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Conversations, their fingerprints without system turns, and as they are."""
    c = conversations(spark, sf_dir)
    files = tl.inventory(c)
    old = tl.metadata_fingerprint(files.filter(~P.in_scope("path", "system")))
    return c, old.select("tree_id", "fingerprint"), tl.metadata_fingerprint(files).select("tree_id", "fingerprint")


def _snapshot_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, old, now = _talk_prints(spark, sf_dir)
    return tl.snapshot_check(old, now)


def _search_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, old, now = _talk_prints(spark, sf_dir)
    return tl.search(c, "the", expected=old, fingerprints=now).select(*MATCH)


def _plan(c: DataFrame) -> DataFrame:
    return tl.scan_plan(c, "the", **SEARCH_LIMITS)


def _budgeted(c: DataFrame) -> DataFrame:
    rows = tl.budgeted_search(c, "the", tl.plan_cuts(_plan(c)), max_matches=SEARCH_LIMITS["max_matches"])
    return rows.select(*MATCH, "rank", "match_limit_reached")


def _search_coverage(c: DataFrame) -> DataFrame:
    plan = _plan(c)
    matches = tl.budgeted_search(c, "the", plan, max_matches=SEARCH_LIMITS["max_matches"])
    return _with_reasons(tl.search_coverage(c, plan, matches))


def _symbols_coverage(c: DataFrame) -> DataFrame:
    rows = _with_reasons(tl.symbols_coverage(c, max_symbols=6, **LEDGER_LIMITS))
    return rows.withColumn("unsupported_languages", _counts("unsupported_languages"))


def _related_coverage(c: DataFrame) -> DataFrame:
    return _with_reasons(tl.related_coverage(c, _entries(c), max_relationships=5, **LEDGER_LIMITS))


def _batch_coverage(c: DataFrame) -> DataFrame:
    return _with_reasons(tl.batch_coverage(c, _batch_requests(c), **BATCH_LIMITS))


def _sources(c: DataFrame) -> DataFrame:
    """Every source file as a target."""
    return tl.kept(c).filter(P.role("path") == "source").select("tree_id", "path")


def _entries(c: DataFrame) -> DataFrame:
    """One target per tree: its first TypeScript source file."""
    files = tl.kept(c).filter((P.role("path") == "source") & (P.language("path") == "typescript"))
    return files.groupBy("tree_id").agg(F.min("path").alias("path"))


def _related_grouped(c: DataFrame) -> DataFrame:
    rows = tl.grouped_related(tl.related(c, _entries(c), max_per_target=6), 300).drop("paths_limit_reached")
    return rows.withColumn("paths", _joined("paths"))


def _rollup(c: DataFrame) -> DataFrame:
    entries = F.transform(F.array_sort(F.map_entries("roles")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return tl.dir_rollup(c, 1).withColumn("roles", F.array_join(entries, ","))


def _guidance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Docs renamed by language, so that trees hold guidance files and folders."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    c = code_files(spark, sf_dir).drop("content").join(docs, "doc_id")
    path = (
        F.when(~P.in_scope("path", "docs"), F.col("path"))
        .when(F.col("lang") == "en", "AGENTS.md")
        .when(F.col("lang") == "fr", F.concat(F.lit(".agents/skills/"), "doc_id", F.lit(".md")))
        .when(F.col("lang") == "de", "WORKFLOW.md")
        .otherwise(F.col("path"))
    )
    return tl.guidance(c.select("tree_id", path.alias("path")))


def _later_hashes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return code_files(spark, sf_dir), moderated_code_files(spark, sf_dir)


def _snapshot_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _later_hashes(spark, sf_dir)
    return tl.compare_snapshots(tl.content_fingerprint(before), tl.content_fingerprint(after))


def _snapshot_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _later_hashes(spark, sf_dir)
    before, after = (tl.metadata_fingerprint(tl.inventory(c)) for c in (first, second))
    snapshots = tl.snapshot(before, tl.files_coverage(first), "metadata")
    rows = tl.verify_snapshot(snapshots, before, after, require_stable=True)
    return rows.withColumn("truncation_reasons", _joined("truncation_reasons"))


def _snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _later_hashes(spark, sf_dir)
    return tl.diff_files(tl.content_hashes(before), tl.content_hashes(after))


def _snapshot_diff_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = (tl.content_hashes(c) for c in _later_hashes(spark, sf_dir))
    changed = tl.changed_directories(tl.directory_fingerprint(before), tl.directory_fingerprint(after))
    return tl.diff_files(before, after, changed)


def _snapshot_diff_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = (tl.content_hashes(c) for c in _later_hashes(spark, sf_dir))
    return tl.diff_changed_trees(before, after, tl.fingerprint_of_hashes(before), tl.fingerprint_of_hashes(after))


def _snapshot(c: DataFrame) -> DataFrame:
    report = tl.read_coverage(c, max_bytes_per_file=COVERAGE_LIMIT)
    prints = tl.content_fingerprint(tl.within_size(c, COVERAGE_LIMIT))
    return tl.snapshot(prints, report, "content").withColumn("truncation_reasons", _joined("truncation_reasons"))


def _merged(c: DataFrame) -> DataFrame:
    read = tl.read_coverage(c, max_bytes_per_file=COVERAGE_LIMIT)
    return _with_reasons(tl.merge_coverage(read, tl.files_coverage(c, max_files=15, max_directories=7)))


def _outline(c: DataFrame) -> DataFrame:
    rows = tl.outline(c, max_files=15, sample=10)
    sample = F.transform("files_sample", lambda x: F.concat_ws(":", x["path"], x["size"].cast("string")))
    return rows.select("tree_id", "fingerprint", F.array_join(sample, ",").alias("files_sample"), "inventory_limit_reached")


def _map(c: DataFrame) -> DataFrame:
    def text(name, *fields, sep=":"):
        items = F.transform(name, lambda x: F.concat_ws(sep, *(x[f].cast("string") for f in fields)))
        return F.array_join(items, ",").alias(name)

    def counts(name):
        items = F.transform(F.array_sort(F.map_entries(name)), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
        return F.array_join(items, ",").alias(name)

    fields = ("path", "size", "language", "role")
    rows = tl.corpus_map(c)
    return rows.select(
        "tree_id", *(text(n, *fields) for n in ("files", "manifests", "ci", "docs", "tests")),
        text("directories", "directory", "files", sep="="), counts("languages"), counts("roles"),
        text("symbols", "path", "line", "kind", "name"),
    )


def queries() -> dict[str, Query]:
    """One entry per operator; all read the whole tables."""
    additions = tl.Policy(ignore_dirs=("Docs",), secret_extensions=("py",), secret_path_parts=("workflows/CI",))
    return {
        # paths, policy, inventory
        "classify_files": _on_code(_classified),
        "policy_class": _on_code(lambda c: c.select("tree_id", "path", tl.DEFAULT_POLICY.classify("path").alias("policy_class"))),
        "policy_additions": _on_code(lambda c: tl.kept(c, additions).select("tree_id", "path")),
        "policy_counts": _on_code(tl.policy_counts),
        "inventory": _on_code(tl.inventory),
        "inventory_scope": _on_code(lambda c: tl.inventory(c, path="src")),
        "inventory_contains": _on_code(lambda c: tl.inventory(c, contains="MOD1")),
        "filter_ext": _on_code(lambda c: tl.inventory(c, extensions=["ts", " .MD "])),
        "within_size": _on_code(lambda c: tl.within_size(tl.inventory(c), 2000)),
        "relative_paths": _on_code(_relative),
        "path_validation": _on_code(_path_requests),
        "directories": _on_code(lambda c: tl.directories(c, tl.DEFAULT_POLICY)),
        "scope_status": _on_code(lambda c: tl.scope_status(c, _scopes(c))),
        "capped_inventory": _on_code(lambda c: tl.capped_inventory(c, max_files=15, max_directories=7)),
        "inventory_cap": _on_code(lambda c: tl.cap_files(c, 15)),
        "dir_cap": _on_code(lambda c: tl.cap_dirs(c, 7)),
        # text
        "decode_status": lambda s, d: tl.decode(documents(s, d)).select("tree_id", "path", "refusal", "encoding"),
        "content_sha256": _on_code(tl.content_hashes),
        "page_sha256": lambda s, d: tl.content_hashes(pages(s, d)),
        "line_counts": _on_code(lambda c: tl.readable(c).select("tree_id", "path", T.line_count("text").alias("total_lines"))),
        "file_lines": _on_code(tl.file_lines),
        "read_ranges": _on_code(lambda c: tl.read_ranges(c, _range_requests(c))),
        "read_ranges_hash_check": _hash_check,
        "read_batch": _on_code(_batch),
        # search
        "search_lines": _on_code(lambda c: tl.search(c, "token")),
        "search_excerpt": _on_code(lambda c: tl.search(c, "the")),
        "search_case_sensitive": _on_code(lambda c: tl.search(c, "The", case_sensitive=True)),
        "search_context": _on_code(_context),
        "matched_files": _on_code(lambda c: tl.matched_files(tl.search(c, "the"))),
        "search_capped": _on_code(lambda c: tl.search(c, "the", max_matches=25)),
        "search_scoped": _on_code(lambda c: tl.search(c, "a", path="docs", contains="mod", extensions=["md"])),
        "search_documents": lambda s, d: tl.search(documents(s, d), "license"),
        "search_pages": lambda s, d: tl.search(pages(s, d), "href"),
        "search_conversations": lambda s, d: tl.search(conversations(s, d), "the"),
        "snapshot_check": _snapshot_check,
        "search_expected": _search_expected,
        "search_budgeted": _on_code(_budgeted),
        "search_coverage": _on_code(_search_coverage),
        # symbols
        "symbols": _on_code(tl.symbols),
        "symbols_filtered": _on_code(lambda c: tl.symbols(c, kind="Class", query="MOD")),
        "symbols_topk": _on_code(lambda c: tl.symbols(c, max_per_tree=12)),
        "symbols_budgeted": _on_code(lambda c: tl.budgeted_symbols(c, max_total_bytes=20000, max_total_lines=60)),
        "unsupported_languages": _on_code(tl.unsupported_languages),
        "with_unsupported": _on_code(_unsupported),
        # imports and relations
        "import_edges": _on_code(tl.import_edges),
        "direct_imports": _on_code(lambda c: tl.direct_imports(tl.import_edges(c), _sources(c))),
        "imported_by": _on_code(lambda c: tl.imported_by(tl.import_edges(c), _sources(c))),
        "likely_tests": _on_code(lambda c: tl.likely_tests(tl.kept(c), _sources(c))),
        "same_basename": _on_code(lambda c: tl.same_basename(tl.kept(c), _sources(c))),
        "siblings": _on_code(lambda c: tl.siblings(tl.kept(c), _entries(c))),
        "tested_stems": _on_code(lambda c: tl.tested_stems(tl.kept(c))),
        "name_groups": _on_code(lambda c: tl.name_groups(tl.kept(c))),
        "related": _on_code(lambda c: tl.related(c, _entries(c))),
        "related_filtered": _on_code(
            lambda c: tl.related(c, _entries(c), kinds=["direct-import", "imported-by", "likely-test"], path_prefix="src/", extensions=["ts"])
        ),
        "related_topk": _on_code(lambda c: tl.related(c, _entries(c), max_per_target=6)),
        "related_grouped": _on_code(_related_grouped),
        "related_grouped_capped": _on_code(
            lambda c: tl.grouped_related(tl.related(c, _entries(c)), 2).withColumn("paths", _joined("paths"))
        ),
        "budgeted_imports": _on_code(lambda c: tl.budgeted_imports(c, _entries(c), **LEDGER_LIMITS)),
        # roll-ups
        "language_counts": _on_code(tl.language_counts),
        "role_counts": _on_code(tl.role_counts),
        "dir_roles": _on_code(tl.dir_roles),
        "dir_rollup": _on_code(_rollup),
        "role_top_n": _on_code(lambda c: tl.role_top_n(c, 3)),
        "guidance": _guidance,
        # budgets
        "budget_bytes_prefix": _on_code(lambda c: tl.byte_prefix(tl.inventory(c), 20000)),
        "budget_bytes_greedy": _on_code(lambda c: tl.byte_greedy(tl.inventory(c), 20000)),
        "scan_budget": _on_code(lambda c: tl.scan_budget(tl.file_facts(c), 20000, 60)),
        "budget_lines_prefix": _on_code(lambda c: tl.line_prefix(tl.file_facts(c), 100)),
        # fingerprints, snapshots, coverage
        "metadata_fingerprint": _on_code(lambda c: tl.metadata_fingerprint(tl.inventory(c))),
        "metadata_fingerprint_with_directories": _on_code(lambda c: tl.metadata_fingerprint(tl.inventory(c), with_directories=True)),
        "content_fingerprint": _on_code(tl.content_fingerprint),
        "layered_fingerprint": _on_code(lambda c: tl.layered_fingerprint(tl.content_hashes(c))),
        "range_fingerprint": _on_code(_range_prints),
        "snapshot": _on_code(_snapshot),
        "snapshot_compare": _snapshot_compare,
        "snapshot_verify": _snapshot_verify,
        "snapshot_diff": _snapshot_diff,
        "files_coverage": _on_code(lambda c: _with_reasons(tl.files_coverage(c, max_files=15, max_directories=7))),
        "read_coverage": _on_code(lambda c: _with_reasons(tl.read_coverage(c, max_bytes_per_file=COVERAGE_LIMIT))),
        "merge_coverage": _on_code(_merged),
        "symbols_coverage": _on_code(_symbols_coverage),
        "related_coverage": _on_code(_related_coverage),
        "batch_coverage": _on_code(_batch_coverage),
        "directory_fingerprint": _on_code(lambda c: tl.directory_fingerprint(tl.content_hashes(c))),
        "snapshot_diff_pruned": _snapshot_diff_pruned,
        "snapshot_diff_trees": _snapshot_diff_trees,
        # files of every branch: symbol kinds, import forms, line ends, BOM, binary content, names shared by many files
        "varied_classify": _on_varied(_classified),
        "varied_decode": _on_varied(lambda c: tl.decode(c).select("tree_id", "path", "refusal", "encoding")),
        "varied_lines": _on_varied(tl.file_lines),
        "varied_symbols": _on_varied(tl.symbols),
        "varied_imports": _on_varied(tl.import_edges),
        "varied_search": _on_varied(lambda c: tl.search(c, "import", max_matches=4)),
        "varied_coverage": _on_varied(lambda c: _with_reasons(tl.read_coverage(c))),
        "likely_tests_capped": _on_varied(lambda c: tl.likely_tests(tl.kept(c), _sources(c), max_per_target=2)),
        "same_basename_capped": _on_varied(lambda c: tl.same_basename(tl.kept(c), _sources(c), max_per_target=3)),
        "siblings_capped": _on_varied(lambda c: tl.siblings(tl.kept(c), _sources(c), max_per_target=2)),
        # reports
        "outline": _on_code(_outline),
        "corpus_map": _on_code(_map),
        "corpus_map_flags": _on_code(_map_flags),
        "outline_report": _on_code(_outline_report),
        "map_report": _on_code(_map_report),
    } | _llm()[0]


def oracle_sql() -> dict[str, str]:
    return oracles.queries() | _llm()[1]
