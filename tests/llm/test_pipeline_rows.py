"""Which row of a SimHash component stays where ids repeat or are missing."""

import random

import corpus_pipeline


def test_one_row_of_each_component(spark):
    rng = random.Random(31)
    long, other, lonely = (" ".join(f"w{rng.randint(0, 999)}" for _ in range(300)) for _ in range(3))
    rows = [(5, long), (5, long), (5, long + " end"), (9, long), (7, other), (7, other), (None, other), (None, lonely), (None, lonely), (7, "alone")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((str(r.doc_id), r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect())
    assert len(got) == 4
    five = [t for i, t in got if i == "5"]
    assert len(five) == 1 and five[0] in (long, long + " end")
    assert [x for x in got if x[0] != "5"] == sorted([("7", other), ("7", "alone"), ("None", lonely)])
