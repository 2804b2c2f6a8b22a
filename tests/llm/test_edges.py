"""Empty tables, clashing column names, nulls and very long texts, where no other test has them."""

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from treelens.llm import bpe_codec, pii, quality, token_counts, toxicity, vectors

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_empty_tables(spark, make):
    none = make([])
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.score(none, toxicity.train(none, labels.select("doc_id", "toxic"))).count() == 0
    grades = labels.select("doc_id", F.col("quality").alias("grade"))
    assert quality.rate(none, quality.train(none, grades, 3)).count() == 0
    assert pii.find_personal_data(none).count() == 0
    assert token_counts.with_token_counts(none, PATH).count() == 0
    assert bpe_codec.round_trip(none, PATH).count() == 0


def test_clashing_names(spark, make):
    docs = make(["a b", None]).withColumn("n_bytes", F.lit("x")).withColumn("n_tokens", F.lit(1)).withColumn("OVER_LIMIT", F.lit(2)).withColumn("ids", F.lit(3))
    rows = token_counts.with_token_counts(docs, PATH).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_tokens, r.over_limit) for r in rows] == [(3, 2, False), (0, 0, False)]
    assert [r.ids for r in bpe_codec.encode(docs, PATH).orderBy("doc_id").collect()] == [[64, 275], []]
    rows = [(1, [1.0, 0.0], "x", 1, 2, None), (2, [1.0, 0.01], "y", 1, 2, None), (3, None, "z", 1, 2, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, kept string, n_links int, component_id int, value string")
    got = vectors.near_duplicates(df).orderBy("vec_id").collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in got] == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_long_texts(make):
    texts = ["ab c" * 400_000, "x" * 300_000, "a@b.cc " * 30_000]
    from tokenizers import Tokenizer

    want = [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert [r.n_tokens for r in token_counts.with_token_counts(make(texts), PATH).orderBy("doc_id").collect()] == want
    assert [r.n_tokens for r in bpe_codec.round_trip(make(texts), PATH).orderBy("doc_id").collect()] == want


def write(spark, folder, docs):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in docs], schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "one two three")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_pipeline_of_no_rows(spark, tmp_path):
    write(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_of_nulls_and_repeated_rows(spark, tmp_path):
    long = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(500))
    write(spark, tmp_path, [(1, None), (2, ""), (None, None), (4, long), (4, long), (5, "has one two three in it"), (6, "plain\n\nother text")])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == corpus_pipeline.COLUMNS, name
    # Null and empty texts are one SimHash component, kept by its smallest id; repeated rows are one document.
    got = sorted((r.doc_id, r.text) for r in docs.collect())
    assert got == [(1, None), (4, long), (6, "plain\n\nother text")]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 3
