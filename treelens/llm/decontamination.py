"""Benchmark decontamination by winnowed fingerprints.

Words are lower-cased (A-Z) runs of digits, small letters and bytes from 0x80. A window
is ``window`` consecutive words of a benchmark item; a shorter item is one window.

1. Fingerprints. Every window keeps its smallest k-gram hash (winnowing), in documents
   as in items, so equal windows share a fingerprint: no shared span of at least
   ``window`` words can be missed. Items shorter than a window are fingerprinted by
   their whole length, which documents repeat for each such length that occurs.
2. Filter. The fingerprints of the benchmark are laid into a bitmap of fixed size (2 MB).
   Documents drop fingerprints outside it in the scan, so almost only true hits
   leave it, however large the corpus is.
3. Join and extend. Fingerprints that are left are extended both ways over the windows
   that selected them, and joined with the fingerprints of the benchmark; a hit is a
   window equal in all its words (64-bit hashes of word sequences). Each document
   position matches at most one distinct window, so rows stay in proportion to the
   words of the documents, also for passages that many items or documents share.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from treelens.llm import arrays, frames

SEED_WORDS = 5
_CANDIDATE = "array<struct<fingerprint: bigint, at: bigint, length: bigint, words: string>>"
_ARROW = pa.struct([("fingerprint", pa.int64()), ("at", pa.int64()), ("length", pa.int64()), ("words", pa.string())])


def _fingerprints(data, offsets, window: int, k: int, short_lengths, whole_only: bool):
    """First words of texts, for all windows fingerprint, start and length, and a function spelling windows.

    ``whole_only``: windows under ``window`` words count only as a whole text.
    """
    starts, ends, first = arrays.word_bounds(data, offsets, arrays.NOT_ALPHANUMERIC)
    grams = arrays.Grams(arrays.word_hashes(data, starts, ends), first)
    at, chosen = arrays.winnow(grams, k, window)
    parts = [(grams.hashes(chosen, k), at, np.full(len(at), window))]
    for n in short_lengths:
        at = grams.starts(n)
        if whole_only:
            at = at[(at == grams.begin[at]) & (at + n == grams.end[at])]
        parts.append((grams.hashes(at, n), at, np.full(len(at), n)))
    raw = data.tobytes()

    def spelled(at: np.ndarray, n: np.ndarray) -> pa.Array:
        """The words of windows with one blank between; cutting at ASCII bytes keeps them valid UTF-8."""
        spans = [(starts[i : i + m].tolist(), ends[i : i + m].tolist()) for i, m in zip(at.tolist(), n.tolist())]
        return pa.array([b" ".join(raw[a:b] for a, b in zip(*span)) for span in spans], pa.binary()).cast(pa.string())

    return first, [np.concatenate(p) for p in zip(*parts)], spelled


def _item_rows(window: int, k: int):
    def rows(batches):
        for batch in batches:
            ids = batch.column("item_id")
            for begin, data, offsets in arrays.slices(*arrays.text_bytes(batch.column("text"))):
                first, (seed, at, n), spelled = _fingerprints(arrays.lower(data), offsets, window, k, range(1, window), True)
                owner = np.searchsorted(first, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(arrays.signed(seed)), pa.array(n), spelled(at, n), ids.take(pa.array(owner + begin))],
                    names=["fingerprint", "length", "words", "item_id"],
                )

    return rows


def _candidates(window: int, k: int, lengths, bits):
    def scan(text: pa.Array) -> pa.Array:
        counts, sizes, found = [], [], []
        for _, data, offsets in arrays.slices(*arrays.text_bytes(text)):
            first, columns, spelled = _fingerprints(arrays.lower(data), offsets, window, k, lengths, False)
            hit = np.flatnonzero(frames.maybe_in(bits, columns[0]))
            seed, at, n = (c[hit] for c in columns)
            owner = np.searchsorted(first, at, side="right") - 1
            order = np.lexsort((n, at))
            counts.append(np.diff(first))
            sizes.append(np.bincount(owner, minlength=len(first) - 1))
            numbers = (arrays.signed(seed[order]), (at - first[owner])[order], n[order])
            found.append([*map(pa.array, numbers), spelled(at[order], n[order])])
        if not counts:
            counts, sizes, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [[pa.array([], f.type) for f in _ARROW]]
        rows = pa.StructArray.from_arrays([pa.concat_arrays(c) for c in zip(*found)], fields=list(_ARROW))
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), rows)
        return pa.StructArray.from_arrays([pa.array(np.concatenate(counts), pa.int64()), lists], names=["n_words", "found"])

    return scan


def _merged(spans: pa.Array) -> pa.Array:
    """Sorted spans of each row, those that touch made one."""
    out = []
    for value in spans:
        start, end = (np.asarray(value.values.field(i), np.int64) for i in (0, 1))
        reach = np.maximum.accumulate(end)
        begins = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
        lasts = np.append(begins[1:], len(start)) - 1
        out.append([{"start": a, "end": b} for a, b in zip(start[begins].tolist(), reach[lasts].tolist())])
    return pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, seed_words: int = SEED_WORDS, keep=None) -> DataFrame:
    """Which words of which documents occur in the benchmark.

    ``docs`` needs ``text``, ``items`` needs ``item_id`` and ``text``. Returns every row of
    ``docs`` with its columns (those in ``keep``, all by default; a column named like a new
    one gives way to it; all columns kept are written once) and n_words, n_hit
    (words inside any occurrence of a window), n_items (items with an occurring window),
    items (their ids as strings, sorted), hits (word ranges, end exclusive, merged).

    Null or empty text: no words, no hits. An item without words has no window. The windows
    of an item whose id is null count in n_hit and hits, but not among the items. Repeated
    documents are judged one by one, repeated items count once. A text of any length is read
    whole, by one task; its hits are merged in one pass. Empty tables give no rows.
    """
    added = ("n_words", "n_hit", "n_items", "items", "hits", "row")
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    benchmark = frames.stored(
        items.mapInArrow(_item_rows(window, seed_words), "fingerprint bigint, length bigint, words string, item_id string").distinct()
    )
    lengths = sorted(r[0] for r in benchmark.filter(F.col("length") < window).select("length").distinct().collect())  # window - 1 at most
    bits = docs.sparkSession.sparkContext.broadcast(frames.bitmap(benchmark, "fingerprint"))
    scan = F.arrow_udf(lambda text: _candidates(window, seed_words, lengths, bits.value)(text), f"n_words bigint, found {_CANDIDATE}")
    rest = frames.without(docs, added)
    names_kept = rest.columns if keep is None else list(keep)
    scanned = rest.withColumn("scan", scan("text")).withColumn("row", F.monotonically_increasing_id())
    # The table fixes the row numbers.
    scanned = frames.stored(scanned.select(*names_kept, "row", "scan.n_words", "scan.found"))

    found = scanned.filter(F.size("found") > 0).select("row", F.explode("found").alias("f")).select("row", "f.*")
    known = benchmark.select("fingerprint", "length", "words").distinct()
    hits = frames.stored(found.join(known, ["fingerprint", "length", "words"]))
    step = F.struct(F.col("at").alias("start"), (F.col("at") + F.col("length")).alias("end"))
    spans = hits.groupBy("row").agg(F.array_sort(F.collect_list(step)).alias("spans"))  # at most one per word and length
    names = (
        hits.select("row", "length", "words").distinct()
        .join(benchmark.select("length", "words", "item_id").filter("item_id is not null").distinct(), ["length", "words"])
        .groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    merged = F.arrow_udf(_merged, "array<struct<start: bigint, end: bigint>>")("spans")
    facts = spans.select("row", merged.alias("hits")).join(names, "row", "left")
    out = scanned.drop("found").join(facts, "row", "left")
    covered = F.expr("aggregate(hits, 0L, (n, x) -> n + x.end - x.start)")
    return out.select(
        *(out[c] for c in names_kept),
        "n_words",
        F.coalesce(covered, F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("hits", F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)")).alias("hits"),
    )


def op7_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=("doc_id",))
    return rows.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


OP7_SQL = """
WITH docs AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w FROM documents
), items AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS s FROM (
    SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)
), doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
), hits AS (SELECT doc_id, n, i, item_id FROM doc_windows JOIN item_windows USING (n, s)
), words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), names AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN names USING (doc_id)
"""
