"""Toxicity by multiple-instance learning: noisy-or over sentences.

A document is a bag of sentences. A sentence has the probability p = sigmoid(bias + sum of
the weights of its hashed words and word beginnings); the document is toxic if any
sentence is: P = 1 - prod(1 - p). Only document labels are needed to train, yet the sentence
probabilities locate what offends.

Training takes at most ``sample_rows`` labelled documents of at most ``sample_chars``
characters each, chosen by a hash of the text, so what the driver holds is bounded
(documented parameters of :func:`train`). Scoring reads every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from treelens.llm import arrays, frames

BUCKET_BITS = 20
PREFIX_BYTES = (4, 5, 6, 7)
_STOP = np.isin(np.arange(256), np.frombuffer(b".!?\n", np.uint8))


def _sentences(data: np.ndarray, offsets: np.ndarray):
    """Buckets of words and their beginnings, the sentence number of each, and per sentence its text, start and end byte.

    Sentences end at full stop, exclamation mark, question mark or line end; those
    without words do not count. A word that repeats the one before it adds nothing.
    """
    starts, ends, first = arrays.word_bounds(data, offsets, arrays.NOT_ALPHANUMERIC)
    hash_range = arrays.range_hasher(data)
    whole = hash_range(starts, ends)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    stops = np.flatnonzero(_STOP[data])
    place = np.searchsorted(stops, starts)
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(new)
    fresh = new.copy()
    fresh[1:] |= whole[1:] != whole[:-1]
    place = np.flatnonzero(fresh)
    parts, number = [whole[place]], [place]
    for n in PREFIX_BYTES:
        long = place[ends[place] - starts[place] >= n]
        parts.append(arrays.mix(hash_range(starts[long], starts[long] + n) + np.uint64(n)))
        number.append(long)
    words = (np.concatenate(parts) & np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int64)
    number = (np.cumsum(new) - 1)[np.concatenate(number)]
    return words, number, owner[begin], starts[begin], ends[np.append(begin[1:], len(starts)) - 1] if len(starts) else ends


@dataclass(frozen=True)
class Model:
    """Weights of the word buckets that have one, and the bias of a sentence."""

    bucket: np.ndarray
    weight: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BUCKET_BITS)
        out[self.bucket] = self.weight
        return out


def held_out(doc_id: Column) -> Column:
    """The fixed fold that training never sees: crc32 of the id as text divisible by 5; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def _features(text: pa.Array) -> pa.Array:
    out = []
    for _, data, offsets in arrays.slices(*arrays.text_bytes(text)):
        words, number, owner, _, _ = _sentences(arrays.lower(data), offsets)
        order = np.argsort(number, kind="stable")
        words, number = words[order], number[order]
        bounds = np.searchsorted(owner[number] if len(number) else number, np.arange(len(offsets)))
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            out.append((number[lo:hi] - (number[lo] if hi > lo else 0)) << BUCKET_BITS | words[lo:hi])
    return pa.array(out, pa.list_(pa.int64()))


def fit(bags: list[np.ndarray], labels: np.ndarray, steps: int = 300, rate: float = 0.3, penalty: float = 5e-6, least_signal: float = 3.5) -> Model:
    """Maximum likelihood with an L2 penalty by Adam.

    Buckets whose share of toxic bags is within ``least_signal`` standard deviations of the
    overall share, or that are in under three bags, get no weight. A bag is an array of sentence number * 2**BUCKET_BITS + word bucket.
    """
    size = 1 << BUCKET_BITS
    counts = np.array([(b[-1] >> BUCKET_BITS) + 1 if len(b) else 0 for b in bags], np.int64)
    shift = np.cumsum(counts) - counts
    sentence = np.concatenate([(b >> BUCKET_BITS) + s for b, s in zip(bags, shift)] or [np.zeros(0, np.int64)])
    word = np.concatenate([b & (size - 1) for b in bags] or [np.zeros(0, np.int64)])
    positive = labels.astype(bool)
    in_bags, in_toxic = np.zeros(size), np.zeros(size)
    for b, toxic in zip(bags, positive):
        own = np.unique(b & (size - 1))
        in_bags[own] += 1
        in_toxic[own] += toxic
    share = positive.mean() if len(bags) else 0.0
    signal = np.abs(in_toxic - share * in_bags) / np.sqrt(in_bags * share * (1 - share) + 1e-9)
    bucket = np.flatnonzero((in_bags >= 3) & (signal >= least_signal))
    place = np.full(size, -1)
    place[bucket] = np.arange(len(bucket))
    known = place[word] >= 0
    sentence, word = sentence[known], place[word[known]]
    n_sentences, bag = int(counts.sum()), np.repeat(np.arange(len(bags)), counts)
    w, bias = np.zeros(len(bucket)), -6.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        z = bias + np.bincount(sentence, w[word], minlength=n_sentences)
        a = np.bincount(bag, _softplus(z), minlength=len(bags))  # P = 1 - exp(-a)
        slope = np.where(positive, -1.0 / np.expm1(np.clip(a, 1e-9, 50.0)), 1.0) / max(len(bags), 1)
        g = slope[bag] / (1.0 + np.exp(-np.clip(z, -50, 50)))
        gradient = np.append(np.bincount(word, g[sentence], minlength=len(w)) + penalty * w, g.sum())
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8) * min(1.0, 2 * (1 - step / (steps + 1)))
        w, bias = w - move[:-1], float(bias - move[-1])
    return Model(bucket, w, bias)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 4000, sample_chars: int = 20_000) -> Model:
    """Train on labelled documents outside the held-out fold.

    At most ``sample_rows`` different texts of at most ``sample_chars`` characters, those with
    the smallest hashes, reach the driver, as hashed words. Null labels, texts and ids are no
    examples; a text counts once, and as toxic if any label of any of its copies says so.
    Without any example the model scores every text with about zero.
    """
    marks = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("_toxic"))
    rows = docs.select("doc_id", "text").filter("text is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    rows = rows.filter(F.length("text") <= sample_chars).withColumn("_order", F.xxhash64("text"))
    # Choosing needs no text: labels and hashes meet first, then the chosen texts are read.
    chosen = rows.select("doc_id", "_order").join(marks, "doc_id").groupBy("_order").agg(F.min("doc_id").alias("doc_id"), F.max("_toxic").alias("_toxic"))
    chosen = chosen.orderBy("_order").limit(sample_rows)
    picked = rows.join(F.broadcast(chosen), ["doc_id", "_order"])
    found = picked.select(F.arrow_udf(_features, "array<bigint>")("text").alias("bag"), "_toxic", "_order").dropDuplicates(["_order"]).toArrow()
    bags = [np.asarray(v.values, np.int64) for c in found["bag"].chunks for v in c]
    return fit(bags, np.asarray(found["_toxic"], np.int64))


_OFFENDING = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def _scorer(weights: np.ndarray, bias: float, threshold: float):
    def of(text: pa.Array) -> pa.Array:
        scores, spans = [], []
        for _, data, offsets in arrays.slices(*arrays.text_bytes(text)):
            words, number, owner, begin, end = _sentences(arrays.lower(data), offsets)
            z = bias + np.bincount(number, weights[words], minlength=len(owner))
            a = np.bincount(owner, _softplus(z), minlength=len(offsets) - 1)
            scores.append(-np.expm1(-a))
            p = np.exp(-_softplus(-z))
            slot = [[] for _ in range(len(offsets) - 1)]
            bad = np.flatnonzero(p >= threshold)
            if len(bad):
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                base = points[offsets[owner[bad]]]
                for i, lo, hi, s in zip(owner[bad].tolist(), (points[begin[bad]] - base).tolist(), (points[end[bad]] - base).tolist(), p[bad].tolist()):
                    slot[i].append({"start": lo, "end": hi, "score": s})
            spans += slot
        flat = np.concatenate(scores) if scores else np.zeros(0)
        return pa.StructArray.from_arrays([pa.array(flat), pa.array(spans, _OFFENDING)], names=["score", "sentences"])

    return of


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``docs`` (all rows and columns; same-named ones give way) with score, predicted, sentences.

    ``sentences`` are the offending ones: code point ranges, end exclusive, and their
    probability. Null, empty and word-less texts score 0 and have none.
    """
    rest = frames.without(docs, ("score", "predicted", "sentences", "_scored"))
    shared = docs.sparkSession.sparkContext.broadcast((model.bucket, model.weight, model.bias))  # 16 bytes a bucket, 2**20 at most

    def scorer(text):
        bucket, weight, bias = shared.value
        return _scorer(Model(bucket, weight, bias).dense(), bias, threshold)(text)

    kind = "score double, sentences array<struct<start: bigint, end: bigint, score: double>>"
    scored = rest.withColumn("_scored", F.arrow_udf(scorer, kind)("text"))
    return scored.select(
        *(scored[c] for c in rest.columns), "_scored.score", (F.col("_scored.score") >= threshold).cast("int").alias("predicted"), "_scored.sentences"
    )


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", F.size("sentences").cast("bigint").alias("n_sentences"))
