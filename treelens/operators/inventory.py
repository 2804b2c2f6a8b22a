"""Inventory of files: scope, policy, directories, prune counts and walk caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from treelens.functions import paths as P
from treelens.functions.policy import DEFAULT_POLICY, Policy
from treelens.plans.materialize import small_side
from treelens.plans.ordered import top_per_group

KEY = ["tree_id", "path"]


def kept(c: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Files the policy lets through."""
    return c.filter(policy.classify("path").isNull() & ~is_link(c))


def is_link(c: DataFrame) -> Column:
    return F.col("unread").eqNullSafe("link") if "unread" in c.columns else F.lit(False)


def fits(c: DataFrame, max_bytes: int | None) -> Column:
    """Files within the size cap of a call and of the reader that loaded the corpus."""
    loaded = ~F.col("unread").eqNullSafe("too-large") if "unread" in c.columns else F.lit(True)
    return loaded if max_bytes is None else loaded & (F.col("size") <= max_bytes)


def path_filter(path: str | None = None, contains: str | None = None, extensions=None) -> Column:
    """Scope, substring and extension filters of a tool call as one predicate."""
    out = P.in_scope("path", path)
    if contains:
        out = out & P.path_contains("path", contains)
    return out & P.ext_in("path", extensions)


def inventory(c: DataFrame, policy: Policy = DEFAULT_POLICY, **filters) -> DataFrame:
    """Metadata rows; the content column is never read."""
    extra = [n for n in ("mtime", "dev", "ino") if n in c.columns]
    return kept(c, policy).filter(path_filter(**filters)).select("tree_id", "path", "size", *extra)


def classify_files(c: DataFrame) -> DataFrame:
    return c.select(
        "tree_id", "path", "size", P.language("path").alias("language"), P.role("path").alias("role")
    )


def directories(c: DataFrame, policy: Policy | None = None) -> DataFrame:
    """Distinct directories implied by the files, '.' for the root.

    With a policy only directories a walk enters are listed: it stops at the
    topmost refused path, so nothing below that path counts.
    """
    path = F.col("path") if policy is None else F.coalesce(policy.pruned_prefix("path"), F.col("path"))
    parent = c.select("tree_id", P.dirname(path).alias("_parent")).distinct()
    segs = P.segments("_parent")
    nested = F.transform(F.sequence(F.lit(1), F.size(segs)), lambda i: F.array_join(F.slice(segs, F.lit(1), i), "/"))
    every = F.when(F.col("_parent") == ".", F.array(F.lit("."))).otherwise(F.concat(F.array(F.lit(".")), nested))
    return parent.select("tree_id", F.explode(every).alias("directory")).distinct()


def policy_counts(c: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Topmost refused paths per tree and class, one count per pruned subtree."""
    return (
        _pruned(c, policy)
        .groupBy("tree_id", "policy_class")
        .agg(F.count("*").alias("skipped"))
    )


def _pruned(c: DataFrame, policy: Policy) -> DataFrame:
    prefix = policy.pruned_prefix("path")
    refused = c.filter(policy.classify("path").isNotNull()).select("tree_id", prefix.alias("prefix")).distinct()
    reason = F.when(policy.is_secret("prefix"), "secret").otherwise("generated")
    return refused.withColumn("policy_class", reason)


def scope_status(c: DataFrame, scopes: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """What became of every scope ``(tree_id, path)`` that a caller names.

    ``status`` is 'absolute-path' or 'outside-tree', 'refused-secret' or 'refused-generated' (the
    scans give no rows then), 'missing' where the tree holds no such file or directory, else 'ok'.
    """
    asked = scopes.select("tree_id", "path", P.clean_path("path").alias("clean"), P.path_error("path").alias("error"))
    asked = small_side(asked)
    segs = P.segments("path")
    above = F.transform(F.sequence(F.lit(1), F.size(segs)), lambda i: F.array_join(F.slice(segs, F.lit(1), i), "/"))
    there = c.select("tree_id", F.explode(F.concat(F.array(F.lit(".")), above)).alias("clean"))
    there = there.join(asked.select("tree_id", "clean").distinct(), ["tree_id", "clean"], "left_semi").distinct().withColumn("_there", F.lit(True))
    status = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(policy.is_secret("clean"), "refused-secret")
        .when(policy.is_generated("clean"), "refused-generated")
        .when(F.col("_there").isNull(), "missing")
        .otherwise("ok")
    )
    return asked.join(there, ["tree_id", "clean"], "left").select("tree_id", "path", status.alias("status"))


def walk_cut(
    c: DataFrame,
    policy: Policy = DEFAULT_POLICY,
    max_files: int | None = None,
    max_directories: int | None = None,
    **filters,
) -> DataFrame:
    """Where the walk of each capped tree stops: the first entry beyond a cap.

    ``cut`` is the walk key of the file number ``max_files + 1`` or directory
    number ``max_directories + 1``, whichever comes first. Trees within their
    caps have no row.
    """
    events = []
    if max_files is not None:
        files = inventory(c, policy, **filters).select("tree_id", "path")
        events.append(_nth(files, "path", max_files, "maxFiles"))
    if max_directories is not None:
        walked = c.filter(P.in_scope("path", filters.get("path")))
        dirs = directories(walked, policy).filter(P.in_scope("directory", filters.get("path")))
        events.append(_nth(dirs, "directory", max_directories, "maxDirectories"))
    if not events:
        return inventory(c).select("tree_id").limit(0).select(
            "tree_id", F.array().cast("array<string>").alias("cut"), F.lit("").alias("reason")
        )
    cuts = events[0] if len(events) == 1 else events[0].unionByName(events[1])
    return cuts.groupBy("tree_id").agg(F.min("cut").alias("cut"), F.min_by("reason", "cut").alias("reason"))


def _directory_key(directory: str) -> Column:
    # The root sorts before everything inside it.
    return F.when(F.col(directory) == ".", F.array().cast("array<string>")).otherwise(P.walk_key(directory))


def _nth(rows: DataFrame, column: str, n: int, reason: str) -> DataFrame:
    key = _directory_key(column) if column == "directory" else P.walk_key(column)
    keyed = rows.select("tree_id", column, key.alias("cut"))
    first = top_per_group(keyed, ["tree_id"], [F.col("cut")], n + 1, salt=[column])
    return first.filter(F.col("rank") == n + 1).select("tree_id", "cut", F.lit(reason).alias("reason"))


def before_cut(files: DataFrame, cuts: DataFrame, through: bool = False) -> DataFrame:
    """Files the walk returned; ``through`` also keeps the file that hit the cap.

    ``cuts`` holds at most one row per tree.
    """
    joined = files.join(small_side(cuts.select("tree_id", "cut")), "tree_id", "left")
    key = P.walk_key("path")
    inside = (key <= F.col("cut")) if through else (key < F.col("cut"))
    return joined.filter(F.col("cut").isNull() | inside).drop("cut")


def capped_inventory(
    c: DataFrame,
    policy: Policy = DEFAULT_POLICY,
    max_files: int | None = None,
    max_directories: int | None = None,
    **filters,
) -> DataFrame:
    """Inventory cut at the caps, in walk order semantics."""
    files = inventory(c, policy, **filters)
    if max_files is None and max_directories is None:
        return files
    return before_cut(files, walk_cut(c, policy, max_files, max_directories, **filters))


def cap_files(c: DataFrame, n: int, policy: Policy = DEFAULT_POLICY, **filters) -> DataFrame:
    return capped_inventory(c, policy, max_files=n, **filters)


def cap_dirs(c: DataFrame, n: int, policy: Policy = DEFAULT_POLICY, **filters) -> DataFrame:
    return capped_inventory(c, policy, max_directories=n, **filters)


def inventory_coverage(
    c: DataFrame,
    policy: Policy = DEFAULT_POLICY,
    max_files: int | None = None,
    max_directories: int | None = None,
    **filters,
) -> DataFrame:
    """Walk counters per tree: candidates, prune counts and the cap that stopped it."""
    scoped = c.filter(P.in_scope("path", filters.get("path")))
    # Files that fail a filter keep their tree in the report without counting.
    kind = F.when(path_filter(**filters), "file").otherwise("filtered")
    files = kept(scoped, policy).select("tree_id", P.walk_key("path").alias("key"), kind.alias("kind"))
    pruned = _pruned(scoped, policy).select(
        "tree_id", P.walk_key("prefix").alias("key"), F.col("policy_class").alias("kind")
    )
    links = scoped.filter(policy.classify("path").isNull() & is_link(c)).select(
        "tree_id", P.walk_key("path").alias("key"), F.lit("link").alias("kind")
    )
    entries = files.unionByName(pruned).unionByName(links)
    capped = max_files is not None or max_directories is not None
    if capped:
        entries = entries.join(small_side(walk_cut(c, policy, max_files, max_directories, **filters)), "tree_id", "left")
    else:
        entries = entries.withColumn("cut", F.lit(None).cast("array<string>")).withColumn("reason", F.lit(None).cast("string"))
    cut, key = F.col("cut"), F.col("key")
    seen = cut.isNull() | (key < cut)
    # The file that hits the cap is already counted as a candidate.
    candidate = (F.col("kind") == "file") & (seen | (key == cut))
    return entries.groupBy("tree_id").agg(
        F.count_if(candidate).alias("candidate_files"),
        F.count_if((F.col("kind") == "secret") & seen).alias("skipped_secret"),
        F.count_if((F.col("kind") == "generated") & seen).alias("skipped_generated"),
        F.count_if((F.col("kind") == "link") & seen).alias("skipped_links"),
        F.bool_or(cut.isNotNull()).alias("inventory_limit_reached"),
        F.max("reason").alias("reason"),
    )
