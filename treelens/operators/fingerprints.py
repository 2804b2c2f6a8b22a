"""Tree fingerprints, snapshots and snapshot comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from treelens.functions import paths as P
from treelens.functions.policy import DEFAULT_POLICY, Policy
from treelens.operators.inventory import KEY, directories
from treelens.operators.reading import content_hashes
from treelens.plans.materialize import materialize, measured, small_side

CHUNK_ENTRIES = 100


def _mtime_text(df: DataFrame) -> Column:
    """Milliseconds with three decimals; '' when the corpus has no times."""
    if "mtime" not in df.columns:
        return F.lit("")
    micros = F.unix_micros("mtime")
    whole = F.expr("abs(unix_micros(mtime)) div 1000").cast("string")
    text = F.concat(F.when(micros < 0, "-").otherwise(""), whole, F.lit("."), F.lpad((F.abs(micros) % 1000).cast("string"), 3, "0"))
    return F.coalesce(text, F.lit(""))


def _fingerprint(entries: DataFrame) -> DataFrame:
    """SHA-256 over the sorted entries of each tree, every entry closed by NUL.

    The sort is spread over all tasks by ranges of (tree, entry). Each range joins
    runs of entries into chunks, and the final pass streams the chunks of a tree
    through one running hash, so memory does not depend on the size of a tree.
    """
    size = CHUNK_ENTRIES

    def join_entries(frames):
        import pandas as pd
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        for frame in frames:
            rows = []
            for tree, group in frame.groupby("tree_id", sort=False):
                values = group["entry"].tolist()
                for i in range(0, len(values), size):
                    run = values[i : i + size]
                    chunk = "".join(v + "\0" for v in run).encode()
                    rows.append((tree, part, seq, len(run), chunk))
                    seq += 1
            yield pd.DataFrame(rows, columns=["tree_id", "part", "seq", "entries", "chunk"])

    def hash_chunks(frames):
        import hashlib

        import pandas as pd

        tree, digest, count = None, None, 0
        for frame in frames:
            done = []
            for row in frame.itertuples(index=False):
                if row.tree_id != tree:
                    if digest is not None:
                        done.append((tree, digest.hexdigest(), count))
                    tree, digest, count = row.tree_id, hashlib.sha256(), 0
                digest.update(row.chunk)
                count += row.entries
            yield pd.DataFrame(done, columns=["tree_id", "fingerprint", "entries"])
        if digest is not None:
            yield pd.DataFrame([(tree, digest.hexdigest(), count)], columns=["tree_id", "fingerprint", "entries"])

    ordered = entries.repartitionByRange("tree_id", "entry").sortWithinPartitions("tree_id", "entry")
    chunks = ordered.mapInPandas(join_entries, "tree_id string, part int, seq bigint, entries bigint, chunk binary")
    per_tree = chunks.repartition("tree_id").sortWithinPartitions("tree_id", "part", "seq")
    return per_tree.mapInPandas(hash_chunks, "tree_id string, fingerprint string, entries bigint")


def metadata_fingerprint(files: DataFrame, with_directories: bool = False) -> DataFrame:
    """Fingerprint of inventory rows: path, type, size, time and identity.

    Tables carry no directory rows; ``with_directories`` adds the directories the
    paths imply, with empty time and identity.
    """

    def text(name):
        return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in files.columns else F.lit("")

    entry = F.concat_ws("\t", "path", F.lit("file"), F.col("size").cast("string"), _mtime_text(files), text("dev"), text("ino"))
    rows = files.select("tree_id", entry.alias("entry"))
    if with_directories:
        dirs = directories(files)
        rows = rows.unionByName(
            dirs.select("tree_id", F.concat("directory", F.lit("\tdirectory\t0\t\t\t")).alias("entry"))
        )
    return _fingerprint(rows)


def fingerprint_of_hashes(hashes: DataFrame) -> DataFrame:
    """Fingerprint of ``(tree_id, path, sha256[, range])`` rows.

    The hashes are written first: the range sort samples its input, which must not
    read and hash all content a second time.
    """
    part = F.coalesce("range", F.lit("")) if "range" in hashes.columns else F.lit("")
    return _fingerprint(materialize(hashes.select("tree_id", F.concat_ws("\t", "path", "sha256", part).alias("entry"))))


def layered_fingerprint(hashes: DataFrame) -> DataFrame:
    """Fingerprint of ``(tree_id, path, sha256[, range])`` rows without a serial pass.

    Its value differs from ``fingerprint_of_hashes``; use it to compare snapshots of
    trees too large to stream through one hash. Entries are hashed in 2^20 buckets
    by the hash of their path, buckets in 4096 groups, groups per tree, so a row of
    any level joins a small share of the tree.
    """
    part = F.coalesce("range", F.lit("")) if "range" in hashes.columns else F.lit("")
    bucket = F.substr(F.sha2("path", 256), F.lit(1), F.lit(5))
    rows = hashes.select("tree_id", bucket.alias("bucket"), F.concat_ws("\t", "path", "sha256", part).alias("entry"), F.lit(1).alias("n"))
    levels = [["tree_id", "bucket"], ["tree_id", "bucket"], ["tree_id"]]
    for depth, keys in enumerate(levels):
        if depth == 1:
            rows = rows.withColumn("entry", F.concat_ws("\t", "bucket", "entry")).withColumn("bucket", F.substr("bucket", F.lit(1), F.lit(3)))
        elif depth == 2:
            rows = rows.withColumn("entry", F.concat_ws("\t", "bucket", "entry"))
        closed = F.transform(F.array_sort(F.collect_list("entry")), lambda e: F.concat(e, F.lit("\0")))
        rows = rows.groupBy(*keys).agg(F.sha2(F.array_join(closed, ""), 256).alias("entry"), F.sum("n").alias("n"))
    return rows.select("tree_id", F.col("entry").alias("fingerprint"), F.col("n").alias("entries"))


def directory_fingerprint(hashes: DataFrame) -> DataFrame:
    """``(tree_id, directory, fingerprint, entries)`` of every directory of ``(tree_id, path, sha256)`` rows, '.' for the root.

    A directory's fingerprint is SHA-256 over its sorted entries ``name, kind, hash``, each closed
    by NUL; the hash of a directory in it is that directory's fingerprint. Equal fingerprints
    mean equal sub-trees. Levels are hashed from the deepest up, one pass each; the entries of
    a directory are sorted by ranges and streamed, so one of any size is hashed. File hashes
    are written once.
    """
    place = F.col("path")
    files = hashes.select("tree_id", P.dirname(place).alias("directory"), F.concat_ws("\t", P.basename(place), F.lit("file"), "sha256").alias("entry"))
    files = materialize(files.withColumn("depth", _depth("directory")))
    deepest = files.agg(F.max("depth")).first()[0]
    levels: list[DataFrame] = []
    below: DataFrame | None = None
    for depth in range(deepest if deepest is not None else -1, -1, -1):
        rows = files.filter(F.col("depth") == depth).select("tree_id", "directory", "entry")
        if below is not None:
            entry = F.concat_ws("\t", P.basename("directory"), F.lit("directory"), "fingerprint")
            rows = rows.unionByName(below.select("tree_id", P.dirname("directory").alias("directory"), entry.alias("entry")))
        # The directory is part of the key under which entries are sorted and hashed; hexadecimal ids hold no '/'.
        keyed = rows.select(F.concat(F.hex(F.encode("tree_id", "UTF-8")), F.lit("/"), "directory").alias("tree_id"), "entry")
        tree = F.decode(F.unhex(F.substring_index("tree_id", "/", 1)), "UTF-8")
        directory = F.substr("tree_id", F.locate("/", "tree_id") + 1)
        below = materialize(_fingerprint(keyed).select(tree.alias("tree_id"), directory.alias("directory"), "fingerprint", "entries"))
        levels.append(below)
    if not levels:
        return hashes.sparkSession.createDataFrame([], "tree_id string, directory string, fingerprint string, entries bigint")
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def _depth(directory: str) -> Column:
    return F.when(F.col(directory) == ".", 0).otherwise(F.size(F.split(directory, "/")))


def changed_directories(before: DataFrame, after: DataFrame) -> DataFrame:
    """Directories of two ``directory_fingerprint`` frames whose sub-trees differ, with both fingerprints (null: not there)."""
    key = ["tree_id", "directory"]
    a = before.select(*key, F.col("fingerprint").alias("before_fingerprint"))
    b = after.select(*key, F.col("fingerprint").alias("after_fingerprint"))
    return a.join(b, key, "full_outer").filter(~F.col("before_fingerprint").eqNullSafe(F.col("after_fingerprint")))


def content_fingerprint(c: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Fingerprint over the content hashes of readable files."""
    return fingerprint_of_hashes(content_hashes(c, policy).select(*KEY, "sha256"))


def snapshot(fingerprints: DataFrame, coverage: DataFrame, kind: str, scope: str = ".") -> DataFrame:
    """Fingerprint and completeness of each tree of a finished coverage report."""
    if kind not in ("metadata", "content"):
        raise ValueError("kind must be metadata or content")
    rows = coverage.join(fingerprints.select("tree_id", "fingerprint"), "tree_id", "left")
    partial_kind = F.when(F.col("partial") & F.lit(kind == "content"), "partial-content").otherwise(kind)
    empty = F.sha2(F.lit(""), 256)  # nothing was hashed
    return rows.select(
        "tree_id",
        F.coalesce("fingerprint", empty).alias("fingerprint"),
        partial_kind.alias("fingerprint_kind"),
        F.lit(P.scope_of(scope)).alias("fingerprint_scope"),
        (~F.col("partial")).alias("complete"),
        F.col("reasons").alias("truncation_reasons"),
    )


def compare_snapshots(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per tree: did the fingerprint change between two snapshots?"""
    a = before.select("tree_id", F.col("fingerprint").alias("before_fingerprint"))
    b = after.select("tree_id", F.col("fingerprint").alias("after_fingerprint"))
    rows = a.join(b, "tree_id", "full_outer")
    return rows.withColumn("changed", ~F.col("before_fingerprint").eqNullSafe(F.col("after_fingerprint")))


def verify_snapshot(snapshots: DataFrame, before: DataFrame, after: DataFrame, require_stable: bool = False) -> DataFrame:
    """Snapshots with the outcome of a second look at the metadata.

    ``before`` and ``after`` are fingerprints of the inventory around the work. A
    change is a reason for partial results; with ``require_stable`` it also turns
    ``status`` into 'stale-snapshot'.
    """
    changes = compare_snapshots(before, after)
    changed = F.coalesce("changed", F.lit(False))
    reasons = F.concat("truncation_reasons", F.when(changed, F.array(F.lit("snapshotChanged"))).otherwise(F.array().cast("array<string>")))
    stale = changed & F.lit(require_stable)
    return (
        snapshots.join(changes, "tree_id", "left")
        .withColumn("stable", ~changed)
        .withColumn("changed", changed)
        .withColumn("truncation_reasons", F.array_sort(F.array_distinct(reasons)))
        .withColumn("status", F.when(stale, "stale-snapshot").otherwise("ok"))
    )


def diff_files(before: DataFrame, after: DataFrame, changed: DataFrame | None = None) -> DataFrame:
    """Per file of two ``(tree_id, path, sha256)`` frames: added, removed, modified or same.

    With ``changed``, rows of ``changed_directories``, only files whose directory is among them
    are compared: equal sub-trees are left out, and so are their files, which are all the same.
    """
    if changed is not None:
        inside = small_side(changed.select("tree_id", F.col("directory").alias("_dir")).distinct())
        before, after = (
            side.withColumn("_dir", P.dirname("path")).join(inside, ["tree_id", "_dir"], "left_semi").drop("_dir") for side in (before, after)
        )
    a = before.select(*KEY, F.col("sha256").alias("before_sha256"))
    b = after.select(*KEY, F.col("sha256").alias("after_sha256"))
    status = (
        F.when(F.col("before_sha256").isNull(), "added")
        .when(F.col("after_sha256").isNull(), "removed")
        .when(F.col("before_sha256") != F.col("after_sha256"), "modified")
        .otherwise("same")
    )
    return a.join(b, KEY, "full_outer").withColumn("status", status)


def write_snapshot(hashes: DataFrame, location: str, mode: str = "error") -> DataFrame:
    """Store ``(tree_id, path, sha256)`` rows with one folder per tree, and read them back.

    Reading the trees of a list then touches the files of these trees only.
    """
    hashes.repartition("tree_id", F.pmod(F.xxhash64("path"), F.lit(16))).write.partitionBy("tree_id").mode(mode).parquet(location)
    return read_snapshot(hashes.sparkSession, location)


def read_snapshot(spark: SparkSession, location: str) -> DataFrame:
    schema = "path string, sha256 string, tree_id string"
    return spark.read.schema(schema).parquet(location).select(*KEY, "sha256")


def diff_changed_trees(before: DataFrame, after: DataFrame, fingerprints_before: DataFrame, fingerprints_after: DataFrame) -> DataFrame:
    """``diff_files`` of the trees whose fingerprints differ; of stored snapshots only those trees are read.

    The trees are a broadcast list up to a measured size, and the partitions of a
    ``write_snapshot`` table are pruned by it while the job runs.
    """
    state = F.when(F.col("changed"), "changed").otherwise("same").alias("state")
    trees, small = measured(compare_snapshots(fingerprints_before, fingerprints_after).select("tree_id", state))
    # The filter tells the optimizer that the list is worth pruning by.
    moved = trees.filter(F.col("state") == "changed").select("tree_id")
    moved = F.broadcast(moved) if small else moved
    return diff_files(before.join(moved, "tree_id"), after.join(moved, "tree_id"))
