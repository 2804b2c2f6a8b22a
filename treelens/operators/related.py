"""Files related to target files: imports, tests, same names, siblings.

``targets(tree_id, path)`` lists the files asked about; results are keyed by
``(tree_id, target_path)``. Relations are joins on exact keys. Targets and grouped
sides are written and measured: small ones are broadcast, of larger ones Spark splits
hot keys (one directory, one file name) with its skew join.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from treelens import constants as K
from treelens.functions import paths as P
from treelens.functions.policy import DEFAULT_POLICY, Policy
from treelens.operators.imports import import_edges
from treelens.operators.inventory import KEY, kept
from treelens.plans.materialize import BROADCAST_BYTES, measured, small_side
from treelens.plans.ordered import top_per_group

COLUMNS = ["tree_id", "target_path", "path", "relationship", "evidence", "confidence", "language", "source_sha256"]


def _targets(targets: DataFrame, *columns: Column) -> DataFrame:
    return targets.select("tree_id", F.col("path").alias("target_path"), *columns)


def _confidence() -> Column:
    kind = F.col("relationship")
    return F.when(kind.isin("direct-import", "imported-by"), "high").when(kind == "likely-test", "medium").otherwise("low")


def _import_relations(edges: DataFrame, targets: DataFrame, kinds, hint=small_side) -> DataFrame:
    """Both directions in one pass: an edge answers for its importer and its import.

    ``hint`` decides how a side as narrow as the targets is joined.
    """
    ends = {"direct-import": ("from_path", "to_path"), "imported-by": ("to_path", "from_path")}
    views = [
        F.struct(F.lit(k).alias("relationship"), F.col(asked).alias("target_path"), F.col(found).alias("path"))
        for k, (asked, found) in ends.items() if k in kinds
    ]
    rows = edges.filter(F.col("to_path").isNotNull()).select(
        "tree_id", F.inline(F.array(*views)), F.col("specifier").alias("evidence"), "source_sha256"
    )
    # A file that imports itself is no importer of the target.
    rows = rows.filter((F.col("relationship") == "direct-import") | (F.col("path") != F.col("target_path")))
    rows = rows.join(hint(_targets(targets)), ["tree_id", "target_path"], "left_semi")
    return rows.withColumn("confidence", _confidence()).withColumn("language", P.language("path")).select(*COLUMNS)


def _tested(name: Column, stem: Column, ext: Column) -> Column:
    """Array of (key, ext): the file stems a test name points at.

    A test answers to its own stem without the test marker and to every ending of
    the text before a '.test' or '.spec' in its name. Listing these endings turns
    the substring rule into an equality. ``ext`` is set where the tested file must
    also share the extension. Keys are distinct per test.
    """

    def heads(marker):
        parts = F.split(name, re.escape(marker), -1)
        before = F.transform(
            F.slice(F.sequence(F.lit(0), F.size(parts)), F.lit(2), F.size(parts) - 1),
            lambda i: F.array_join(F.slice(parts, F.lit(1), i), marker),
        )
        before = F.filter(before, lambda h: h != "")
        return F.flatten(F.transform(before, lambda h: F.transform(F.sequence(F.lit(1), F.length(h)), lambda i: F.substr(h, i))))

    unmarked = F.regexp_replace(stem, K.TEST_STEM_SUFFIX, "")
    stems = F.array_distinct(F.concat(F.array(unmarked), heads(".test"), heads(".spec")))
    free = F.transform(stems, lambda k: F.struct(k.alias("key"), F.lit(None).cast("string").alias("ext")))
    bare = F.regexp_extract(stem, r"(?s)\A(.*)test\z", 1)
    bound = F.array(F.struct(bare.alias("key"), ext.alias("ext")))
    return F.when((bare != "") & ~F.array_contains(stems, bare), F.concat(free, bound)).otherwise(free)


def _file_keys(files: DataFrame, kinds) -> DataFrame:
    """Files with the keys under which each relation finds them."""
    lower = [F.lower(P.basename("path")), F.lower(P.stem("path")), F.lower(P.extension("path"))]
    rows = files.select(
        *KEY, P.dirname("path").alias("_dir"), *(c.alias(n) for c, n in zip(lower, ("_name", "_stem", "_ext"))),
        P.role("path").alias("_role"),
    )
    no_ext = F.lit(None).cast("string")

    def plain(kind, column):
        return F.array(F.struct(F.lit(kind).alias("relationship"), F.col(column).alias("key"), no_ext.alias("ext")))

    tests = F.transform(
        _tested(F.col("_name"), F.col("_stem"), F.col("_ext")),
        lambda t: F.struct(F.lit("likely-test").alias("relationship"), t["key"].alias("key"), t["ext"].alias("ext")),
    )
    nothing = F.array().cast("array<struct<relationship:string,key:string,ext:string>>")
    parts = {
        "likely-test": F.when(F.col("_role") == "test", tests).otherwise(nothing),
        "same-basename": plain("same-basename", "_stem"),
        "sibling": plain("sibling", "_dir"),
    }
    return rows.select(*KEY, F.inline(F.concat(*(v for k, v in parts.items() if k in kinds))))


def _name_relations(files: DataFrame, targets: DataFrame, kinds, hint=small_side, max_per_target: int | None = None) -> DataFrame:
    """Relations by names: one join on (tree, relation, key) for all of them.

    With ``max_per_target`` a key keeps its first files only, as many as a target can need: so
    many, the target itself and one that tells there are more. Targets meet just these, so
    rows grow with the targets, also where all files share one name.
    """
    stem = F.lower(P.stem("path"))
    keys = {"likely-test": stem, "same-basename": stem, "sibling": P.dirname("path")}
    wanted = F.array(*(F.struct(F.lit(k).alias("relationship"), v.alias("key")) for k, v in keys.items() if k in kinds))
    asked = _targets(targets, F.lower(P.extension("path")).alias("target_ext"), F.inline(wanted))
    rows = _file_keys(files, kinds)
    if max_per_target is not None:
        order = [P.locale_key("path"), F.col("path")]
        keyed = rows.withColumn("_ext", F.coalesce("ext", F.lit("")))
        rows = top_per_group(keyed, ["tree_id", "relationship", "key", "_ext"], order, max_per_target + 2, ["path"], "_place").drop("_place", "_ext")
    rows = rows.join(hint(asked), ["tree_id", "relationship", "key"])
    rows = rows.filter(F.col("ext").isNull() | (F.col("ext") == F.col("target_ext")))
    rows = rows.filter(F.col("path") != F.col("target_path"))
    kind = F.col("relationship")
    evidence = (
        F.when(kind == "likely-test", K.TEST_EVIDENCE)
        .when(kind == "same-basename", F.concat(F.lit("same basename as "), P.basename("target_path")))
        .otherwise(F.concat(F.lit("same directory "), P.dirname("target_path")))
    )
    rows = rows.select(
        "tree_id", "target_path", "path", "relationship", evidence.alias("evidence"), _confidence().alias("confidence"),
        P.language("path").alias("language"), F.lit(None).cast("string").alias("source_sha256"),
    )
    if max_per_target is None:
        return rows
    order = [P.locale_key("path"), F.col("path")]
    group = ["tree_id", "target_path", "relationship"]
    return top_per_group(rows, group, order, max_per_target, ["path"], "rank", "relationship_limit_reached")


def direct_imports(edges: DataFrame, targets: DataFrame) -> DataFrame:
    """Files a target imports."""
    return _import_relations(edges, targets, ["direct-import"])


def imported_by(edges: DataFrame, targets: DataFrame) -> DataFrame:
    """Files that import a target."""
    return _import_relations(edges, targets, ["imported-by"])


def likely_tests(files: DataFrame, targets: DataFrame, max_per_target: int | None = None) -> DataFrame:
    """Tests whose name points at a target; with a cap the first of each target by path, ``rank`` and ``relationship_limit_reached``."""
    return _name_relations(files, targets, ["likely-test"], max_per_target=max_per_target)


def same_basename(files: DataFrame, targets: DataFrame, max_per_target: int | None = None) -> DataFrame:
    """Files with the stem of a target, in any directory and with any extension; the cap as in ``likely_tests``."""
    return _name_relations(files, targets, ["same-basename"], max_per_target=max_per_target)


def siblings(files: DataFrame, targets: DataFrame, max_per_target: int | None = None) -> DataFrame:
    """Files in the directory of a target; the cap as in ``likely_tests``."""
    return _name_relations(files, targets, ["sibling"], max_per_target=max_per_target)


def tested_stems(files: DataFrame) -> DataFrame:
    """``(tree_id, path, tested_stem, tested_ext)``: names each test file may test.

    The corpus-wide form of ``likely_tests``: it grows with the tests, not with
    the pairs of tests and tested files.
    """
    rows = _file_keys(files, ["likely-test"])
    return rows.select(*KEY, F.col("key").alias("tested_stem"), F.col("ext").alias("tested_ext"))


def filter_related(r: DataFrame, kinds=None, path_prefix=None, extensions=None, include_low: bool = True) -> DataFrame:
    """Filters of a call. ``path_prefix`` is a plain prefix: 'src' also keeps 'src2/x'."""
    if kinds is not None:
        r = r.filter(F.col("relationship").isin(*kinds))
    if not include_low:
        r = r.filter(F.col("confidence") != "low")
    if path_prefix:
        prefix = path_prefix[:-1] if path_prefix.endswith("/") else path_prefix
        r = r.filter(F.startswith(F.col("path"), F.lit(prefix)))
    return r.filter(P.ext_in("path", extensions))


def related(
    c: DataFrame,
    targets: DataFrame,
    kinds=None,
    path_prefix: str | None = None,
    extensions=None,
    include_low: bool = True,
    max_per_target: int | None = None,
    policy: Policy = DEFAULT_POLICY,
    edges: DataFrame | None = None,
) -> DataFrame:
    """All relations of each target. ``edges`` may be a stored import graph.

    The cap keeps relations in discovery order (imports of the target first, then
    file by file), not by confidence.
    """
    unknown = set(kinds or ()) - set(K.RELATIONSHIPS)
    if unknown:
        raise ValueError(f"unknown relationship kinds: {sorted(unknown)}")
    low = ("same-basename", "sibling")
    wanted = [k for k in K.RELATIONSHIPS if (kinds is None or k in kinds) and (include_low or k not in low)]
    if not wanted:
        raise ValueError("no relationship kind left to look for")
    by_import = [k for k in wanted if k in ("direct-import", "imported-by")]
    by_name = [k for k in wanted if k not in by_import]
    # Every side made of targets has at most three rows a target, each with one more part of the path.
    targets, small = measured(targets.select(*KEY), BROADCAST_BYTES // 16)
    hint = F.broadcast if small else small_side
    trees = hint(targets.select("tree_id").distinct())
    parts = []
    if by_import:
        if edges is None:
            edges = import_edges(c.join(trees, "tree_id", "left_semi"), policy)
        parts.append(_import_relations(edges, targets, by_import, hint))
    if by_name:
        files = kept(c, policy).select(*KEY).join(trees, "tree_id", "left_semi")
        parts.append(_name_relations(files, targets, by_name, hint))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # The builders emit distinct (relationship, path, evidence) per target.
    rows = filter_related(rows, path_prefix=path_prefix, extensions=extensions)
    if max_per_target is None:
        return rows
    imports_first = F.when(F.col("relationship") == "direct-import", 0).otherwise(1)
    by_file = F.when(imports_first == 1, F.col("path")).otherwise(F.lit(""))
    step = F.array_position(F.array(*map(F.lit, ("likely-test", "same-basename", "sibling", "imported-by"))), F.col("relationship"))
    order = [imports_first, P.locale_key(by_file), by_file, step, F.col("evidence")]
    return top_per_group(
        rows, ["tree_id", "target_path"], order, max_per_target, ["path", "evidence"], "rank", "relationship_limit_reached"
    )


def grouped_related(r: DataFrame, max_paths: int) -> DataFrame:
    """Relations per kind of each target: their number and the first paths.

    The count covers all relations; the list is a report of at most ``max_paths``, and
    ``paths_limit_reached`` tells whether there are more.
    """
    group = ["tree_id", "target_path", "relationship"]
    counts = r.groupBy(*group).agg(F.count("*").alias("relations"))
    listed = top_per_group(r.select(*group, "path").distinct(), group, [F.col("path")], max_paths, ["path"], "rank", "paths_limit_reached")
    paths = listed.groupBy(*group).agg(F.array_sort(F.collect_list("path")).alias("paths"), F.bool_or("paths_limit_reached").alias("paths_limit_reached"))
    return counts.join(paths, group)


def name_groups(files: DataFrame) -> DataFrame:
    """Per file the number of files sharing its directory and its stem.

    This answers "how many siblings and same-named files" for every file at once
    without forming pairs: counts are aggregated before they meet the files.
    """
    keyed = files.select(*KEY, P.dirname("path").alias("directory"), F.lower(P.stem("path")).alias("stem"))
    dirs = small_side(keyed.groupBy("tree_id", "directory").agg(F.count("*").alias("_dir")))
    stems = small_side(keyed.groupBy("tree_id", "stem").agg(F.count("*").alias("_stem")))
    rows = keyed.join(dirs, ["tree_id", "directory"]).join(stems, ["tree_id", "stem"])
    return rows.select(*KEY, (F.col("_dir") - 1).alias("siblings"), (F.col("_stem") - 1).alias("same_basename"))
