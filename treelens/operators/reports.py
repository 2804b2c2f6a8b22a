"""Whole-tree reports: outline and map, one row per tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from treelens import constants as K
from treelens.functions import paths as P
from treelens.functions.policy import DEFAULT_POLICY, Policy
from treelens.operators.budgets import budgeted_symbols, symbol_cuts
from treelens.operators.coverage import files_coverage
from treelens.operators.fingerprints import fingerprint_of_hashes, metadata_fingerprint, snapshot
from treelens.operators.inventory import KEY, before_cut, classify_files, inventory, walk_cut
from treelens.operators.ledger import symbols_coverage
from treelens.operators.reading import content_hashes
from treelens.operators.rollup import dir_rollup_of, first_files, guidance
from treelens.operators.symbols import ORDER, symbols
from treelens.plans.materialize import materialize, small_side
from treelens.plans.ordered import top_per_group


def _ranked_list(fields, condition=None):
    """Aggregate: the rows of a group by ``rank`` as structs of ``fields``."""
    item = F.struct("rank", *fields)
    items = F.collect_list(item if condition is None else F.when(condition, item))
    ordered = F.array_sort(items, lambda a, b: (a["rank"] - b["rank"]).cast("int"))
    return F.transform(ordered, lambda x: F.struct(*(x[f].alias(f) for f in fields)))


def _listed(rows: DataFrame, name: str, *fields: str) -> DataFrame:
    """Bounded lists: ``rows`` were cut to a few per tree and carry a ``rank``."""
    return rows.groupBy("tree_id").agg(_ranked_list(fields).alias(name))


def _counted(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Counts per language or role, a fixed small set of keys."""
    return rows.groupBy("tree_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "files")))).alias(name))


def _guidance_list(c: DataFrame, policy: Policy) -> DataFrame:
    return guidance(c, policy).groupBy("tree_id").agg(F.array_sort(F.collect_list("guidance")).alias("guidance"))


def outline(
    c: DataFrame,
    policy: Policy = DEFAULT_POLICY,
    max_files: int | None = None,
    sample: int = K.OUTLINE_SAMPLE,
    max_directories: int | None = None,
) -> DataFrame:
    """Guidance, a sample of the first files and the metadata fingerprint of each tree.

    Without ``max_files`` the fingerprint covers the whole tree; ``sample`` bounds the list only.
    """
    cuts = walk_cut(c, policy, max_files, max_directories)
    files = inventory(c, policy)
    listed = _listed(first_files(before_cut(files, cuts), sample), "files_sample", "path", "size")
    prints = metadata_fingerprint(before_cut(files, cuts, through=True))
    capped = cuts.select("tree_id", F.lit(True).alias("inventory_limit_reached"))
    # A tree without any kept file still has its row, with the fingerprint of no entries.
    rows = c.select("tree_id").distinct().join(prints.select("tree_id", "fingerprint"), "tree_id", "left")
    rows = rows.withColumn("fingerprint", F.coalesce("fingerprint", F.sha2(F.lit(""), 256))).join(listed, "tree_id", "left").join(_guidance_list(c, policy), "tree_id", "left")
    rows = rows.join(capped, "tree_id", "left")
    rows = rows.withColumn("files_sample", F.coalesce("files_sample", F.array().cast(rows.schema["files_sample"].dataType)))
    return rows.withColumn("guidance", F.coalesce("guidance", F.array().cast("array<string>"))).withColumn(
        "inventory_limit_reached", F.coalesce("inventory_limit_reached", F.lit(False))
    )


def corpus_map(
    c: DataFrame,
    depth: int = 2,
    policy: Policy = DEFAULT_POLICY,
    max_files: int | None = None,
    include_symbols: bool = True,
    path: str | None = None,
    max_directories: int | None = None,
    max_listed_files: int = K.MAP_FILES,
    max_listed_directories: int = K.MAP_DIRECTORIES,
    max_listed_per_role: int = K.MAP_ROLE_LIST,
    max_listed_symbols: int = K.MAP_SYMBOLS,
) -> DataFrame:
    """Guidance, file sample, directories, languages, roles, role lists and symbols.

    The ``max_listed`` arguments bound the lists of a row, so it stays small however large
    its tree is. ``total_files`` and the role counts cover the whole tree, and
    ``<list>_limit_reached`` tells for every list whether there are more.
    """
    scoped = c.filter(P.in_scope("path", path))
    if max_files is not None or max_directories is not None:
        scoped = before_cut(scoped, walk_cut(scoped, policy, max_files, max_directories))
    # One pass over the metadata: every part below starts from these narrow rows.
    files = materialize(classify_files(inventory(scoped, policy)))
    fields = ("path", "size", "language", "role")
    by_path = [P.locale_key("path"), F.col("path")]

    dirs = dir_rollup_of(files, depth)
    dirs = top_per_group(dirs, ["tree_id"], [P.locale_key("directory"), F.col("directory")], max_listed_directories, ["directory"], "rank", "over")
    named = {"manifest": "manifests", "ci": "ci", "doc": "docs", "test": "tests"}
    by_role = top_per_group(files.filter(F.col("role").isin(*named)), ["tree_id", "role"], by_path, max_listed_per_role, ["path"], "rank", "over")
    role_lists = by_role.groupBy("tree_id").agg(
        *(_ranked_list(fields, F.col("role") == role).alias(name) for role, name in named.items()),
        *(F.bool_or((F.col("role") == role) & F.col("over")).alias(f"{name}_limit_reached") for role, name in named.items()),
    )
    parts = [
        _guidance_list(c, policy),
        _listed(first_files(files, max_listed_files), "files", *fields),
        _listed(dirs, "directories", "directory", "files", "roles"),
        _counted(files.groupBy("tree_id", "role").agg(F.count("*").alias("files")), "role", "roles"),
        role_lists,
        files.groupBy("tree_id").agg(F.count("*").alias("total_files")),
        dirs.groupBy("tree_id").agg(F.bool_or("over").alias("directories_limit_reached")),
    ]
    if include_symbols:
        order_fields = ("path", *ORDER, "signature")
        found = symbols(scoped, max_per_tree=max_listed_symbols, policy=policy)
        parts.append(_listed(found, "symbols", *order_fields))
        parts.append(found.groupBy("tree_id").agg(F.bool_or("symbol_limit_reached").alias("symbols_limit_reached")))
    # A tree without any kept file still has its row.
    rows = c.select("tree_id").distinct()
    parts.append(_counted(files.groupBy("tree_id", "language").agg(F.count("*").alias("files")), "language", "languages"))
    for part in parts:
        rows = rows.join(part, "tree_id", "left")
    rows = rows.withColumn("files_limit_reached", F.col("total_files") > max_listed_files)
    empty = {"array": F.array, "map": F.create_map, "boolean": lambda: F.lit(False), "long": lambda: F.lit(0)}
    holes = {f.name: empty[f.dataType.typeName()]().cast(f.dataType) for f in rows.schema if f.dataType.typeName() in empty}
    return rows.withColumns({n: F.coalesce(n, value) for n, value in holes.items()})


def _with_envelope(rows: DataFrame, coverage: DataFrame, prints: DataFrame, kind: str, scope: str | None = None) -> DataFrame:
    """Report rows with ``snapshot`` and ``coverage`` structs."""
    shots = snapshot(prints, coverage, kind, scope or ".")
    inside = [n for n in coverage.columns if n != "tree_id"]
    shots = shots.select("tree_id", F.struct(*(n for n in shots.columns if n != "tree_id")).alias("snapshot"))
    return rows.join(shots, "tree_id").join(coverage.select("tree_id", F.struct(*inside).alias("coverage")), "tree_id")


def outline_report(
    c: DataFrame, policy: Policy = DEFAULT_POLICY, max_files: int | None = None, max_directories: int | None = None, sample: int = K.OUTLINE_SAMPLE
) -> DataFrame:
    """``outline`` with the coverage of its walk and the snapshot it describes."""
    rows = outline(c, policy, max_files, sample, max_directories)
    coverage = materialize(files_coverage(c, policy, max_files, max_directories))
    return _with_envelope(rows, coverage, rows.select("tree_id", "fingerprint"), "metadata")


def map_report(
    c: DataFrame,
    depth: int = 2,
    policy: Policy = DEFAULT_POLICY,
    path: str | None = None,
    max_files: int | None = None,
    max_directories: int | None = None,
    max_bytes_per_file: int | None = None,
    max_total_bytes: int | None = None,
    max_total_lines: int | None = None,
    max_listed_symbols: int = K.MAP_SYMBOLS,
    **lists,
) -> DataFrame:
    """``corpus_map`` with symbols under budgets, the merged coverage of walk and symbol scan, and fingerprints.

    ``snapshot`` describes the metadata of the walk, ``symbol_fingerprint`` the contents of the
    files in which symbols were looked for.
    """
    scoped = c.filter(P.in_scope("path", path))
    walked = scoped
    if max_files is not None or max_directories is not None:
        walked = before_cut(scoped, walk_cut(scoped, policy, max_files, max_directories))
    limits = dict(max_total_bytes=max_total_bytes, max_total_lines=max_total_lines, max_bytes_per_file=max_bytes_per_file)
    rows = corpus_map(c, depth, policy, max_files, False, path, max_directories, **lists)
    found = budgeted_symbols(walked, policy=policy, max_per_tree=max_listed_symbols, **limits)
    listed = _listed(found, "symbols", "path", *ORDER, "signature")
    more = found.groupBy("tree_id").agg(F.bool_or("symbol_limit_reached").alias("symbols_limit_reached"))
    coverage = materialize(
        symbols_coverage(c, policy, max_files, max_directories, max_symbols=max_listed_symbols, path=path, **limits)
    )
    cuts = symbol_cuts(walked, policy=policy, **limits)
    read = content_hashes(walked, policy).select(*KEY, "sha256").join(small_side(cuts.granted.select(*KEY)), KEY, "left_semi")
    symbol_prints = fingerprint_of_hashes(read).select("tree_id", F.col("fingerprint").alias("symbol_fingerprint"))
    rows = rows.join(listed, "tree_id", "left").join(more, "tree_id", "left").join(symbol_prints, "tree_id", "left")
    rows = rows.withColumn("symbols_limit_reached", F.coalesce("symbols_limit_reached", F.lit(False)))
    rows = rows.withColumn("symbol_fingerprint", F.coalesce("symbol_fingerprint", F.sha2(F.lit(""), 256)))
    rows = rows.withColumn("symbols", F.coalesce("symbols", F.array().cast(rows.schema["symbols"].dataType)))
    # Like the walk itself, the fingerprint covers the file that hit the cap.
    through = inventory(c, policy, path=path)
    if max_files is not None or max_directories is not None:
        through = before_cut(through, walk_cut(scoped, policy, max_files, max_directories), through=True)
    return _with_envelope(rows, coverage, metadata_fingerprint(through), "metadata", path)
