"""Cleaning pipeline over ``documents``: five stages, each an operator of treelens.llm.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but
the last return the columns of ``documents``. ``run`` writes each stage to the shared
folder and reads it back, so a lost executor never repeats an earlier stage.

For every stage an empty table gives no rows, and repeated rows are judged alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from treelens.llm import bpe_codec, decontamination, frames, line_blocks, simhash, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: No SQL engine trains the toxicity model or runs BPE; the stages are tested against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose noisy-or over sentences stays under one half; so do null and empty texts."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).filter("predicted = 0").select(*COLUMNS)


def dedupe_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the later occurrences of equal or similar lines; every document stays, null texts as they are."""
    return line_blocks.dedupe_similar_lines(docs).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component; null and blank texts are one component."""
    return simhash.one_of_each(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs; null and empty texts have none."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    judged = decontamination.contamination(frames.marked(docs), items, keep=("doc_id", "_content"))
    return frames.rejecting(docs.select(*COLUMNS), judged.filter("n_hit > 0"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text left (null: empty), decoded again: n_tokens and the digests of both."""
    import public_tokenizers

    return bpe_codec.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedupe_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("bpe_codec", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = frames.stored(docs)
    return docs
