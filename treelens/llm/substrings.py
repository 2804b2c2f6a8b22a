"""Substring dedup: seeds from winnowing, extended both ways to maximal repeats.

A *window* is ``window`` consecutive words of one document. A window is a repeat if
the same words start in a document with a smaller ``doc_id``. Maximal repeats are
the unions of overlapping repeated windows, so each has at least ``window`` words.

1. Seed. Winnowing keeps one k-gram (the anchor) per window; equal windows keep equal
   anchors. With k-grams of 16 words and windows of 50 about one word in 18 is an
   anchor. Only anchors that several documents share go on.
2. Extend. Anchors meet on their hash. The text an anchor can be extended over - up to
   ``window - k`` words to each side, less at the ends of the text - is its context.
   Occurrences of one whole context extend over all of it: one row each settles it
   against the smallest document of that context. Where contexts of one anchor
   differ, only the first document of each context goes on, and its extension is
   cut into the windows around the anchor; a window belongs to the smallest document
   that has it. So a passage shared by n documents costs n rows, never n * n pairs.
3. Keep. Each document gets the contexts and windows that a smaller document has; their
   words are merged into maximal repeats.

Anchors come from fast hashes, which may bring different sequences together but never keep
equal ones apart. What decides is a BLAKE2b of the words of a context or window, with a salt
drawn for each run, beside the fast hash: some 125 bits that no text can be made to collide on.

Everything is keyed by content and ``doc_id``: rows that repeat a ``doc_id`` are judged
each by its own text and do not count as smaller than one another.
"""

from __future__ import annotations

import functools
import hashlib
import secrets

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from treelens.llm import arrays, frames

SEED_WORDS = 16


def _digester(data, starts, ends, salt: bytes):
    """A function giving a salted 64-bit digest of words[lo:hi], one blank between, for arrays of bounds."""

    @functools.cache
    def spelled():
        length = ends - starts
        at = np.concatenate([[0], np.cumsum(length + 1)])
        out = np.full(at[-1], 0x20, np.uint8)
        out[np.repeat(np.arange(len(length)), length) + np.arange(length.sum())] = arrays.ragged_take(data, starts, length)
        return out.tobytes(), at

    def digests(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        raw, at = spelled()
        blake = hashlib.blake2b
        return np.frombuffer(b"".join([blake(raw[a:b], digest_size=8, salt=salt).digest() for a, b in zip(at[lo].tolist(), (at[hi] - 1).tolist())]), "<u8")

    return digests


def _anchors(data, offsets, window: int, k: int, salt: bytes):
    """First words of texts, their grams, windows with their anchors, anchors, their bounds of extension, and digests of contexts and of words."""
    starts, ends, first = arrays.word_bounds(data, offsets, arrays.WHITE_SPACE)
    grams = arrays.Grams(arrays.word_hashes(data, starts, ends), first)
    at, chosen = arrays.winnow(grams, k, window)
    mark = np.zeros(grams.words + 1, bool)
    mark[chosen] = True
    anchors = np.flatnonzero(mark)
    low = np.maximum(anchors - (window - k), grams.begin[anchors])
    high = np.minimum(anchors + window, grams.end[anchors])
    digests = _digester(data, starts, ends, salt)

    def context(j=slice(None)) -> np.ndarray:
        # The place of the anchor in its context is part of the context.
        return arrays.mix(digests(low[j], high[j]) + (anchors[j] - low[j]).astype(np.uint64))

    return first, grams, at, chosen, anchors, low, high, context, digests


def _seed_rows(window: int, k: int, salt: bytes):
    def rows(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for begin, data, offsets in arrays.slices(*arrays.text_bytes(batch.column("text"))):
                first, grams, _, _, anchors, _, _, context, _ = _anchors(data, offsets, window, k, salt)
                owner = np.searchsorted(first, anchors, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(arrays.signed(grams.hashes(anchors, k))), pa.array(arrays.signed(context())), ids.take(pa.array(owner + begin))],
                    names=["anchor", "context", "doc_id"],
                )

    return rows


def _window_rows(window: int, k: int, salt: bytes):
    """Windows around the anchors whose contexts a document has to extend word by word."""

    def rows(batches):
        for batch in batches:
            ids, asked = batch.column("doc_id"), batch.column("contexts")
            for begin, data, offsets in arrays.slices(*arrays.text_bytes(batch.column("text"))):
                first, grams, at, chosen, anchors, _, _, context, digests = _anchors(data, offsets, window, k, salt)
                open_anchor = np.zeros(grams.words + 1, bool)
                bounds, contexts = np.searchsorted(anchors, first), context()
                for i in range(len(offsets) - 1):
                    lo, hi = bounds[i], bounds[i + 1]
                    open_anchor[anchors[lo:hi][np.isin(contexts[lo:hi], _wanted(asked, begin + i))]] = True
                at = at[open_anchor[chosen]]
                owner = np.searchsorted(first, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(arrays.signed(grams.second(at, at + window))), pa.array(arrays.signed(digests(at, at + window))), ids.take(pa.array(owner + begin))],
                    names=["window", "digest", "doc_id"],
                )

    return rows


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _wanted(column, i: int, field: str | None = None) -> np.ndarray:
    value = column[i]
    if not value.is_valid:
        return np.zeros(0, np.uint64)
    return np.asarray(value.values.field(field) if field else value.values, dtype=np.int64).view(np.uint64)


def _keep(window: int, k: int, salt: bytes):
    """Per document: kept text, number of words, removed words, maximal repeats."""

    def rows(batches):
        for batch in batches:
            contexts, windows = batch.column("contexts"), batch.column("windows")
            kept, counts, removed, spans = [], [], [], []
            for begin, data, offsets in arrays.slices(*arrays.text_bytes(batch.column("text"))):
                first, grams, at, _, anchors, low, high, context, digests = _anchors(data, offsets, window, k, salt)
                raw = data.tobytes()
                by_anchor, by_window = np.searchsorted(anchors, first), np.searchsorted(at, first)
                for i in range(len(offsets) - 1):
                    own, other = _wanted(contexts, begin + i), _wanted(windows, begin + i, "window")
                    words = raw[offsets[i] : offsets[i + 1]].split()
                    if len(own) or len(other):
                        steps = np.zeros(len(words) + 1, np.int64)
                        if len(own):
                            j = slice(by_anchor[i], by_anchor[i + 1])
                            hit = np.isin(context(j), own)
                            np.add.at(steps, low[j][hit] - first[i], 1)
                            np.add.at(steps, high[j][hit] - first[i], -1)
                        if len(other):
                            own_at = at[by_window[i] : by_window[i + 1]]
                            own_at = own_at[np.isin(grams.second(own_at, own_at + window), other)]
                            own_at = own_at[np.isin(digests(own_at, own_at + window), _wanted(windows, begin + i, "digest"))]
                            np.add.at(steps, own_at - first[i], 1)
                            np.add.at(steps, own_at + window - first[i], -1)
                        covered = np.concatenate([[False], np.cumsum(steps)[:-1] > 0, [False]])
                        edges = np.flatnonzero(covered[1:] != covered[:-1])
                        spans.append([{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
                        rest = [w for w, c in zip(words, covered[1:-1].tolist()) if not c]
                    else:
                        spans.append([])
                        rest = words
                    counts.append(len(words))
                    removed.append(len(words) - len(rest))
                    kept.append(b" ".join(rest))
            # Cutting between words keeps the text valid UTF-8.
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, _SPANS),
                ],
                names=["doc_id", "kept_text", "n_words", "n_removed", "repeats"],
            )

    return rows


def remove_repeats(docs: DataFrame, window: int = 50, seed_words: int = SEED_WORDS) -> DataFrame:
    """Cut every word that a window repeated from a smaller document covers.

    ``docs`` needs ``doc_id`` (any integer type) and ``text``; other columns are ignored.
    Returns one row per input row: doc_id, kept_text (kept words, one space between),
    n_words, n_removed, repeats (word ranges of the maximal repeats, end exclusive).

    Null text: no words, empty kept text. Null doc_id: the text is kept whole and repeats
    nothing for others. Texts under ``window`` words are kept whole. Repeats within
    one document, or among rows of one doc_id, stay. A text of any length is read whole, by one
    task, with arrays of some 100 bytes a word. Empty tables give no rows.
    """
    if not 1 <= seed_words <= window <= seed_words + 63:
        raise ValueError("seed_words must lie between window - 63 and window")
    salt = secrets.token_bytes(hashlib.blake2b.SALT_SIZE)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    known = docs.filter("doc_id is not null")
    seeds = frames.stored(known.mapInArrow(_seed_rows(window, seed_words, salt), "anchor bigint, context bigint, doc_id bigint"))

    contexts = seeds.groupBy("anchor", "context").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    shared = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n_contexts"), F.min("least").alias("a"), F.max("most").alias("b"))
    shared = shared.filter("a < b").select("anchor", "n_contexts")
    contexts = frames.stored(contexts.join(shared, "anchor").filter("n_contexts > 1 or least < most"))
    # The first document of a context provides its windows; all others are settled by it.
    settled = seeds.join(contexts.filter("least < most"), ["anchor", "context"]).filter("doc_id > least")
    settled = settled.groupBy("doc_id").agg(F.collect_set("context").alias("contexts"))
    open_ = contexts.filter("n_contexts > 1").groupBy(F.col("least").alias("doc_id")).agg(F.collect_set("context").alias("contexts"))

    windows = frames.stored(known.join(open_, "doc_id").mapInArrow(_window_rows(window, seed_words, salt), "window bigint, digest bigint, doc_id bigint"))
    first = windows.groupBy("window", "digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    covered = windows.join(first, ["window", "digest"]).filter("doc_id > least").groupBy("doc_id").agg(F.collect_set(F.struct("window", "digest")).alias("windows"))

    return (
        docs.join(settled, "doc_id", "left")
        .join(covered, "doc_id", "left")
        .select("doc_id", "text", "contexts", "windows")
        .mapInArrow(
            _keep(window, seed_words, salt),
            "doc_id bigint, kept_text string, n_words bigint, n_removed bigint, repeats array<struct<start: bigint, end: bigint>>",
        )
    )


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = remove_repeats(docs.select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), F.size("repeats").cast("bigint").alias("n_repeats"))


OP2_SQL = """
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)
), firsts AS (SELECT h, min(doc_id) AS least FROM windows GROUP BY h HAVING min(doc_id) < max(doc_id)
), hits AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN firsts USING (h) WHERE doc_id > least
), dropped AS (SELECT doc_id, list(p) AS ps FROM hits GROUP BY doc_id
), steps AS (SELECT doc_id, count(*) AS n_repeats FROM hits a WHERE NOT EXISTS (FROM hits b WHERE b.doc_id = a.doc_id AND b.p = a.p - 1) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256,
  coalesce(n_repeats, 0)::BIGINT AS n_repeats
FROM words LEFT JOIN dropped USING (doc_id) LEFT JOIN steps USING (doc_id)
"""
