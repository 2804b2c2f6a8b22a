"""Training samples where one text has very many copies."""

import random

from pyspark.sql import functions as F
from treelens.llm import quality, toxicity


def with_copies(make, texts):
    """The texts, and as many copies of the one whose hash is smallest among those that training may see."""
    seen = make(texts).filter(~toxicity.held_out(F.col("doc_id")))
    hot = seen.orderBy(F.xxhash64("text")).first().doc_id
    return make(texts + [texts[hot]] * len(texts)), hot


def test_toxicity_trains_on_distinct_texts(spark, make):
    rng = random.Random(3)
    calm = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(60)]
    texts = [" ".join(rng.choice(calm) for _ in range(8)) + (" vile." if i % 3 == 0 else ".") for i in range(300)]
    docs, hot = with_copies(make, texts)
    labels = spark.createDataFrame([(i, int((i if i < 300 else hot) % 3 == 0)) for i in range(600)], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, toxicity.train(docs, labels, sample_rows=240)).collect()}
    assert all(got[i] == (i % 3 == 0) for i in range(300))


def test_quality_trains_on_distinct_texts(spark, make):
    rng = random.Random(4)
    texts = [" ".join([("###" if i % 3 == 0 else "good"), *("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(6))]) for i in range(300)]
    docs, hot = with_copies(make, texts)
    grades = spark.createDataFrame([(i, 0 if (i if i < 300 else hot) % 3 == 0 else 2) for i in range(600)], "doc_id long, grade int")
    got = {r.doc_id: r.kept for r in quality.rate(docs, quality.train(docs, grades, 3, sample_rows=240)).collect()}
    assert all(got[i] == (i % 3 != 0) for i in range(300))
