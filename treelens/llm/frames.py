"""Helpers on Spark frames: written tables, bitmaps as row filters, per-text functions."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from treelens.plans.materialize import measured


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a local master without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = f"file://{tempfile.mkdtemp(prefix='treelens-llm-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Scratch:
    """A folder for tables on the way to a result, deleted where its ``with`` block ends.

    What outlives the block must be written elsewhere by then, with ``stored(df)``.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, f"{shared_folder(spark)}/llm/{uuid.uuid4().hex}"

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def stored(df: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; lineage ends there.

    A lost executor costs only the files being read again, never the work before. The
    table lives as long as ``scratch``; without one the library never deletes it.
    """
    spark = df.sparkSession
    folder = scratch.path if scratch else f"{shared_folder(spark)}/llm"
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names) -> DataFrame:
    """Drop columns whose names (case ignored, as Spark resolves them) an operator is about to add."""
    taken = {n.lower() for n in names}
    return df.select(*(df[f"`{c.replace('`', '``')}`"] for c in df.columns if c.lower() not in taken))


def marked(docs: DataFrame) -> DataFrame:
    """doc_id, text and a hash of the text, by which ``rejecting`` finds the row again."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("_content"))


def rejecting(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``rejected (doc_id, _content)`` names; null ids count as equal.

    The rejected rows carry no texts. They are broadcast up to a measured 32 MB; beyond it the
    join shuffles the texts.
    """
    rejected, small = measured(rejected.select(F.col("doc_id").alias("_id"), F.col("_content").alias("_hash")).distinct())
    rejected = F.broadcast(rejected) if small else rejected
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    return docs.join(rejected, same, "left_anti")


def bitmap(df: DataFrame, column: str, bits: int = 24) -> np.ndarray:
    """A set of 64-bit hashes as 2**bits bits, found by their lowest ``bits`` bits.

    At most 2**bits / 8 bytes reach the driver, whatever the number of rows (2 MB by
    default), so the result may be shipped to every task. It answers "maybe" or
    "no"; an exact join has to follow.
    """
    low = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), low.bitwiseAND(F.lit(63)).cast("int"))
    words = (
        df.select(F.shiftright(low, 6).cast("int").alias("slot"), bit.alias("bit"))
        .groupBy("slot")
        .agg(F.bit_or("bit").alias("bit"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words["slot"].to_numpy()] = words["bit"].to_numpy().view(np.uint64)
    return out


def maybe_in(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which unsigned hashes the bitmap may hold."""
    low = h & np.uint64(len(bits) * 64 - 1)
    return (bits[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) == 1
