"""Cut lineage through the shared checkpoint folder of the cluster."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_BYTES = 32 << 20


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="treelens-checkpoint-")
    context.setCheckpointDir(shared)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once and continue from the written rows.

    Used for narrow per-file rows only, where the next step needs fixed
    partition numbers or would otherwise compute content hashes twice.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def small_side(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """A narrow join side: broadcast when its measured size allows.

    Spark estimates the size of derived frames from their input, so a table of one
    row per tree would make it shuffle the file contents it is joined with. Here
    the rows are written and measured first. Larger sides come back without a hint
    and take the shuffle join, whose hot keys adaptive execution splits: a written
    side, grouped before or not, is a plain shuffle.
    """
    pinned, small = measured(df, max_bytes)
    return F.broadcast(pinned) if small else pinned


def measured(df: DataFrame, max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """The written rows, and whether they take at most ``max_bytes`` (``BROADCAST_BYTES`` by default)."""
    max_bytes = BROADCAST_BYTES if max_bytes is None else max_bytes
    pinned = materialize(df)
    text = F.concat_ws("", *(F.col(c).cast("string") for c in pinned.columns))
    size = pinned.agg(F.coalesce(F.sum(F.octet_length(text) + 16 * len(pinned.columns)), F.lit(0))).first()[0]
    return pinned, size <= max_bytes
