"""Counts and short lists per tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from treelens import constants as K
from treelens.functions import paths as P
from treelens.functions.policy import DEFAULT_POLICY, Policy
from treelens.operators.inventory import classify_files, kept
from treelens.plans.ordered import top_per_group


def language_counts(c: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    files = kept(c, policy).select("tree_id", P.language("path").alias("language"))
    return files.groupBy("tree_id", "language").agg(F.count("*").alias("files"))


def role_counts(c: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    files = kept(c, policy).select("tree_id", P.role("path").alias("role"))
    return files.groupBy("tree_id", "role").agg(F.count("*").alias("files"))


def _dir_roles_of(files: DataFrame, depth: int) -> DataFrame:
    parent = F.substring_index(P.dirname("path"), "/", max(1, depth))
    rows = files.select("tree_id", parent.alias("directory"), "role").filter(F.col("directory") != ".")
    return rows.groupBy("tree_id", "directory", "role").agg(F.count("*").alias("files"))


def dir_rollup_of(files: DataFrame, depth: int) -> DataFrame:
    """Directory roll-up of rows that already carry their ``role``."""
    per_role = F.map_from_entries(F.array_sort(F.collect_list(F.struct("role", "files"))))  # at most 7 roles
    return _dir_roles_of(files, depth).groupBy("tree_id", "directory").agg(F.sum("files").alias("files"), per_role.alias("roles"))


def _with_role(c: DataFrame, policy: Policy) -> DataFrame:
    return kept(c, policy).select("tree_id", "path", P.role("path").alias("role"))


def dir_roles(c: DataFrame, depth: int = 2, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Files per directory and role; each file counts once, at ``depth`` or above.

    Files at the root of a tree belong to no directory.
    """
    return _dir_roles_of(_with_role(c, policy), depth)


def dir_rollup(c: DataFrame, depth: int = 2, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """One row per directory with its file count and a map role -> count."""
    return dir_rollup_of(_with_role(c, policy), depth)


def role_top_n(c: DataFrame, n: int, roles=("manifest", "ci", "doc", "test"), policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """First ``n`` files by path for each role of each tree."""
    files = classify_files(kept(c, policy)).filter(F.col("role").isin(*roles))
    return top_per_group(files, ["tree_id", "role"], [P.locale_key("path"), F.col("path")], n, ["path"])


def first_files(files: DataFrame, n: int) -> DataFrame:
    """First ``n`` files of each tree by path."""
    return top_per_group(files, ["tree_id"], [P.locale_key("path"), F.col("path")], n, ["path"])


def guidance(c: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Well-known guidance files and directories present in each tree."""
    path = F.col("path")
    # A candidate is named by the file itself or, for a directory, by any file below.
    hit = F.array_compact(
        F.array(*(F.when((path == g) | F.startswith(path, F.lit(g + "/")), F.lit(g)) for g in K.GUIDANCE_PATHS))
    )
    rows = c.filter(P.any_of(*(F.startswith(path, F.lit(g)) for g in K.GUIDANCE_PATHS)))
    rows = rows.select("tree_id", F.explode(hit).alias("guidance")).distinct()
    return rows.filter(policy.classify("guidance").isNull())
