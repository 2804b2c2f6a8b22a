"""Quality by ordinal cumulative-link regression on graded ratings.

A text has one score z = w . x over hashed features shared by all grades, and ordered
thresholds t1 < t2 < ... turn it into grades: P(grade >= k) = sigmoid(z - t_k). The
expected grade is the sum of these tails; a text is kept if the tail at ``keep_from``
reaches one half.

Features are shares of the words of a text: hashed words, hashed word shapes (runs of
capitals, small letters, digits, other characters), and words equal to the one before.
Training takes at most ``sample_rows`` rated documents of at most ``sample_chars``
characters (documented parameters); scoring reads every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from treelens.llm import arrays, frames
from treelens.llm.toxicity import held_out

BUCKET_BITS = 18
_SIZE = 1 << BUCKET_BITS
_REPEAT = 0  # bucket of a word equal to the one before
#: Byte classes of a shape: capital, small letter (any byte from 0x80 too), digit; others stand for themselves.
_SHAPE = np.array([65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256)], np.uint8)


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets, the text of each, and the number of words per text."""
    starts, ends, first = arrays.word_bounds(data, offsets, arrays.WHITE_SPACE)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    words = arrays.range_hashes(arrays.lower(data), starts, ends)
    shape = _SHAPE[data]
    new = np.ones(len(data), bool)
    new[1:] = shape[1:] != shape[:-1]
    new[starts] = True
    place = np.concatenate([[0], np.cumsum(new)])
    shapes = arrays.range_hashes(shape[new], place[starts], place[ends])
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    pack = lambda h: 1 + (h % np.uint64(_SIZE - 1)).astype(np.int64)
    buckets = np.concatenate([pack(words), pack(arrays.mix(shapes + np.uint64(7))), np.full(int(same.sum()), _REPEAT)])
    return buckets, np.concatenate([owner, owner, owner[same]]), np.diff(first)


@dataclass(frozen=True)
class Model:
    weight: np.ndarray  # by bucket
    thresholds: np.ndarray  # ascending


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def fit(rows: list[np.ndarray], words: np.ndarray, grades: np.ndarray, n_grades: int, steps: int = 250, rate: float = 0.5, penalty: float = 1e-6, least_rows: int = 10) -> Model:
    """Maximum likelihood with an L2 penalty by Adam; buckets in under ``least_rows`` rows get no weight.

    Thresholds are one free value and positive steps, so they stay in order. Grades that
    no row has only widen a step.
    """
    seen = np.zeros(_SIZE)
    for r in rows:
        seen[np.unique(r)] += 1
    bucket = np.concatenate(rows or [np.zeros(0, np.int64)])
    text = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    stay = seen[bucket] >= least_rows
    key, count = np.unique(text[stay] * _SIZE + bucket[stay], return_counts=True)
    text, bucket = key // _SIZE, key % _SIZE
    used, place = np.unique(bucket, return_inverse=True)
    value = np.sqrt(count / np.maximum(words[text], 1))
    n, k = max(len(rows), 1), n_grades - 1
    w, theta = np.zeros(len(used)), np.concatenate([[-1.0], np.full(k - 1, 0.5)])
    m, v = np.zeros(len(w) + k), np.zeros(len(w) + k)
    for step in range(1, steps + 1):
        z = np.bincount(text, w[place] * value, minlength=len(rows))
        t = np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])]))
        tails = np.concatenate([np.ones((len(rows), 1)), _sigmoid(z[:, None] - t), np.zeros((len(rows), 1))], axis=1)
        at = np.arange(len(rows))
        high, low = tails[at, grades], tails[at, grades + 1]
        p = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high), low * (1 - low)
        g = -(d_high - d_low) / p / n  # slope of the loss along z
        d_t = np.zeros((len(rows), k + 2))
        d_t[at, grades] += d_high / p / n
        d_t[at, grades + 1] -= d_low / p / n
        by_t = d_t[:, 1:-1].sum(axis=0)
        after = np.cumsum(by_t[::-1])[::-1]
        gradient = np.concatenate([np.bincount(place, g[text] * value, minlength=len(w)) + penalty * w, after[:1], after[1:] * np.exp(theta[1:])])
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8) * min(1.0, 2 * (1 - step / (steps + 1)))
        w, theta = w - move[: len(w)], theta - move[len(w) :]
    weight = np.zeros(_SIZE)
    weight[used] = w
    return Model(weight, np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])])))


def _rows(text: pa.Array) -> pa.Array:
    out, n_words = [], []
    for _, data, offsets in arrays.slices(*arrays.text_bytes(text)):
        buckets, owner, words = _features(data, offsets)
        order = np.argsort(owner, kind="stable")
        bounds = np.searchsorted(owner[order], np.arange(len(offsets)))
        out += [buckets[order[lo:hi]] for lo, hi in zip(bounds[:-1], bounds[1:])]
        n_words.append(words)
    flat = np.concatenate(n_words) if n_words else np.zeros(0, np.int64)
    return pa.StructArray.from_arrays([pa.array(out, pa.list_(pa.int64())), pa.array(flat, pa.int64())], names=["buckets", "words"])


def train(docs: DataFrame, ratings: DataFrame, n_grades: int, sample_rows: int = 6000, sample_chars: int = 20_000) -> Model:
    """Train on ``ratings (doc_id, grade)``, grades 0 to n_grades - 1, outside the held-out fold.

    At most ``sample_rows`` different texts of at most ``sample_chars`` characters, those with
    the smallest hashes, reach the driver, as hashed features. Null or unknown grades, texts
    and ids are no examples; a text counts once, with the lowest grade of any of its copies.
    Without any example all texts get what the thresholds give.
    """
    marks = ratings.filter(F.col("grade").between(0, n_grades - 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(F.col("grade").cast("int")).alias("_grade"))
    rows = docs.select("doc_id", "text").filter("text is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    rows = rows.filter(F.length("text") <= sample_chars).withColumn("_order", F.xxhash64("text"))
    # Choosing needs no text: grades and hashes meet first, then the chosen texts are read.
    chosen = rows.select("doc_id", "_order").join(marks, "doc_id").groupBy("_order").agg(F.min("doc_id").alias("doc_id"), F.min("_grade").alias("_grade"))
    chosen = chosen.orderBy("_order").limit(sample_rows)
    picked = rows.join(F.broadcast(chosen), ["doc_id", "_order"])
    found = picked.select(F.arrow_udf(_rows, "buckets array<bigint>, words bigint")("text").alias("x"), "_grade", "_order")
    found = found.dropDuplicates(["_order"]).orderBy("_order").select("x.*", "_grade").toArrow()
    bags = [np.asarray(v.values, np.int64) for c in found["buckets"].chunks for v in c]
    return fit(bags, np.asarray(found["words"], np.int64), np.asarray(found["_grade"], np.int64), n_grades)


def _scorer(weight: np.ndarray, thresholds: np.ndarray, keep_from: int):
    def of(text: pa.Array) -> pa.Array:
        z = []
        for _, data, offsets in arrays.slices(*arrays.text_bytes(text)):
            buckets, owner, words = _features(data, offsets)
            carries = weight[buckets] != 0
            key, count = np.unique(owner[carries] * _SIZE + buckets[carries], return_counts=True)
            own = key // _SIZE
            z.append(np.bincount(own, weight[key % _SIZE] * np.sqrt(count / np.maximum(words[own], 1)), minlength=len(words)))
        flat = np.concatenate(z) if z else np.zeros(0)
        tails = _sigmoid(flat[:, None] - thresholds)
        return pa.StructArray.from_arrays([pa.array(tails.sum(axis=1)), pa.array(tails[:, keep_from - 1].copy())], names=["expected_grade", "tail_probability"])

    return of


def rate(docs: DataFrame, model: Model, keep_from: int = 1) -> DataFrame:
    """``docs`` (all rows and columns; same-named ones give way) with expected_grade, tail_probability, kept.

    tail_probability is that of a grade of at least ``keep_from``; kept means one half or
    more. Null, empty and word-less texts have z = 0 and get what the thresholds give.
    """
    rest = frames.without(docs, ("expected_grade", "tail_probability", "kept", "_rated"))
    shared = docs.sparkSession.sparkContext.broadcast((model.weight.astype(np.float32), model.thresholds))  # 2**18 weights
    rated = rest.withColumn("_rated", F.arrow_udf(lambda text: _scorer(*shared.value, keep_from)(text), "expected_grade double, tail_probability double")("text"))
    return rated.select(*(rated[c] for c in rest.columns), "_rated.*").withColumn("kept", F.col("tail_probability") >= 0.5)


def op3_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Grades from ``labels``: 0 poor, 1 good but toxic, 2 good."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    grade = F.col("quality") * (2 - F.coalesce("toxic", F.lit(0)))
    rows = rate(docs, train(docs, labels.select("doc_id", grade.alias("grade")), 3))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "expected_grade", "tail_probability", "kept")
