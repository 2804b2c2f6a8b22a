"""File trees on a shared file system as a corpus.

Spark's own binary file source hides names that start with '.' or '_', which
would lose CI files, ``__init__.py`` and every secret count. Listing and reading
are separate steps, so the path policy removes rows before any byte is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from treelens.functions.policy import DEFAULT_POLICY, Policy
from treelens.plans.materialize import materialize

LISTING = "tree_id string, path string, location string, size bigint, mtime timestamp, dev string, ino string, unread string"
CONTENT_BATCH_BYTES = 32 << 20
ENTRIES_PER_TASK = 50_000
_CHUNK_ROWS = 10_000


def _visitor(limit: int):
    """Rows of files below the directories of a frame, and of directories left for a later round."""

    def visit(frames):
        import datetime
        import os
        import stat

        import pandas as pd

        columns = ["tree_id", "path", "location", "size", "mtime", "dev", "ino", "unread", "root", "below"]
        rows, listed = [], 0

        def written():
            # A column without any value would lose its type.
            frame = pd.DataFrame(rows, columns=columns).astype({"tree_id": object, "below": object, "root": object, "location": object, "unread": object})
            rows.clear()
            return frame

        def left(tree, root, here):
            return (tree, None, None, None, None, None, None, None, root, here)

        for frame in frames:
            pending = list(frame[["tree_id", "root", "here"]].itertuples(index=False, name=None))
            while pending:
                tree, root, here = pending.pop()
                if listed >= limit:
                    rows.append(left(tree, root, here))
                else:
                    with os.scandir(here) as entries:
                        for entry in entries:
                            listed += 1
                            info = entry.stat(follow_symlinks=False)
                            if stat.S_ISDIR(info.st_mode):
                                if len(pending) < limit:
                                    pending.append((tree, root, entry.path))
                                else:
                                    rows.append(left(tree, root, entry.path))
                            elif stat.S_ISREG(info.st_mode) or stat.S_ISLNK(info.st_mode):
                                regular = stat.S_ISREG(info.st_mode)
                                rows.append((
                                    tree, os.path.relpath(entry.path, root).replace(os.sep, "/"),
                                    entry.path if regular else None,  # links are listed, never followed
                                    info.st_size if regular else 0,
                                    datetime.datetime.fromtimestamp(info.st_mtime, datetime.timezone.utc),
                                    str(info.st_dev), str(info.st_ino), None if regular else "link", root, None,
                                ))
                            if len(rows) >= _CHUNK_ROWS:
                                yield written()
                if len(rows) >= _CHUNK_ROWS:
                    yield written()
        if rows:
            yield written()

    return visit


def list_tree(spark: SparkSession, roots: dict[str, str], slices: int = 64, entries_per_task: int = ENTRIES_PER_TASK) -> DataFrame:
    """Files and links below each root, hidden names included, without reading them.

    The listing runs in rounds of ``slices`` tasks. A task lists the directories it is given
    and those below, and after ``entries_per_task`` entries hands the directories it has not
    come to over to the next round, so neither a deep nor a wide tree stays in one task and no
    list of names is on the driver. A directory's own entries are streamed in chunks.

    ``unread`` is 'link' for links: no inventory lists them, coverage counts them as unreadable.
    """
    frontier = spark.createDataFrame([(t, r, r) for t, r in sorted(roots.items())], "tree_id string, root string, here string")
    visit, found = _visitor(entries_per_task), []
    while True:
        rounds = materialize(frontier.repartition(slices, "here").mapInPandas(visit, f"{LISTING}, root string, below string"))
        found.append(rounds.filter("below IS NULL").drop("root", "below"))
        frontier = rounds.filter("below IS NOT NULL").select("tree_id", "root", F.col("below").alias("here"))
        if frontier.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def load_content(listing: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Read the bytes of listed files; where they stay null, ``unread`` tells why.

    It is 'link', 'refused', 'too-large' (over ``max_bytes``) or 'unreadable'.
    """
    budget = CONTENT_BATCH_BYTES

    def read(frames):
        import pandas as pd

        for frame in frames:
            rows, held = [], 0
            for row in frame.itertuples(index=False):
                content, unread = None, row.unread
                if unread is None and max_bytes is not None and row.size > max_bytes:
                    unread = "too-large"
                if unread is None:
                    try:
                        with open(row.location, "rb") as handle:
                            content = handle.read()
                    except OSError:
                        unread = "unreadable"
                rows.append((*row[:-1], unread, content))
                held += len(content or b"")
                if held > budget:
                    yield pd.DataFrame(rows, columns=[*frame.columns, "content"])
                    rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=[*frame.columns, "content"])

    # Spread files over all tasks by path: one huge directory must not stay in one task.
    spread = listing.repartition("tree_id", "path")
    return spread.mapInPandas(read, LISTING + ", content binary").drop("location")


def read_tree(
    spark: SparkSession,
    roots: dict[str, str],
    policy: Policy = DEFAULT_POLICY,
    max_bytes: int | None = None,
    slices: int = 64,
) -> DataFrame:
    """Corpus of all roots. Files the policy refuses are listed with null content."""
    listing = list_tree(spark, roots, slices)
    refused = F.when(policy.classify("path").isNotNull(), "refused")
    return load_content(listing.withColumn("unread", F.coalesce("unread", refused)), max_bytes)


def write_table(df: DataFrame, location: str, format: str = "parquet", mode: str = "error") -> None:
    """Result sink: any frame of this library as a Parquet or JSON table."""
    df.write.format(format).mode(mode).save(location)
