"""Ranked search against a plain scan of all documents for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from treelens.llm import ranked_search as S

CAPITALS = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def split(text):
    return TERM.findall((text or "").translate(CAPITALS))


def plain(docs, items, k=20):
    """(item_id, rank, doc_id, score) of all items; docs and items are (id, text)."""
    held = [(d, Counter(t), len(t)) for d, text in docs if (t := split(text))]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, tf, _ in held for t in tf)
    out = []
    for item, text in set(items):
        found = []
        for doc, tf, n in held:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = 0
            for term in split(text):
                if term in tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += w * ((1000000000 * tf[term]) // (1000 * tf[term] + 12 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc, score))
        found.sort(key=lambda f: f[:3])
        out += [(item, rank, f[3], f[4]) for rank, f in enumerate(found[:k], 1)]
    return Counter(out)


def got(df):
    return Counter(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


def some(seed, n, most):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["The", "the", "THE", "Éa", "éa", "x1", "日本", "a_b", "ß"]
    return [" ".join(rng.choice(words[: rng.choice([8, 69])] + words[60:]) + rng.choice(["", ".", "\n", "-"]) for _ in range(rng.randint(0, most))) for _ in range(n)]


def test_search_equals_plain_scan(spark, make):
    texts = some(1, 400, 60) + [None, "", "...", "the " * 400_000] + ["copy of the copy w3"] * 300
    ids = [None if i in (3, 4) else i // 2 if i < 40 else i for i in range(len(texts))]
    items = list(enumerate(some(2, 40, 50))) + [(100, None), (101, ""), (102, "the the w3"), (102, "the the w3"), (102, "w4 zzz"), (None, "copy"), (103, "zzz")]
    items += [(200, "w1 " * 3000 + " ".join(some(3, 1, 3000)))]
    asked = spark.createDataFrame(items, "item_id bigint, text string").withColumn("rank", F.lit("x")).withColumn("score", F.lit(0))
    docs = make(texts, ids).repartition(7)
    want = plain(list(zip(ids, texts)), items)
    assert got(S.ranked_search(docs, asked)) == want
    assert got(S.ranked_search(docs, asked, item_bytes=500)) == want  # many blocks of items
    assert got(S.ranked_search(docs, asked, k=3)) == plain(list(zip(ids, texts)), items, 3)


def test_search_of_nothing(spark, make):
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    for docs in (make([]), make([None, "", "?"]), make(["b"])):
        assert S.ranked_search(docs, items).count() == 0
    assert S.ranked_search(make(["a"]), items.limit(0)).count() == 0
    assert S.ranked_search(make(["a"]), items.withColumn("text", F.lit(None).cast("string"))).count() == 0


def test_shared_sums_equal_plain_sums():
    rng = random.Random(4)
    items = [[rng.randrange(30) for _ in range(rng.randint(0, 40))] for _ in range(60)] + [[1, 1, 1, 2], [1, 1, 2, 3], []]
    plan = S.share(items, 30)
    values = np.random.default_rng(0).integers(0, 1000, (30, 5))
    sums = np.zeros((plan.rows, 5), np.int64)
    sums[:30] = values
    assert (plan.evaluate(sums) == np.array([values[i].sum(axis=0) for i in items])).all()
    # Every node is used, and there are fewer additions than without sharing.
    added = sum(len(left) for left, _ in plan.levels) + len(plan.rest)
    assert plan.levels and added < 0.7 * sum(map(len, items))


def test_identical_items_share_all():
    plan = S.share([[0, 1, 2, 3, 4, 5, 6, 7]] * 5, 8)
    assert len(plan.rest) == 5 and sum(len(left) for left, _ in plan.levels) == 7
