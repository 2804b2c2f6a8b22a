"""Ranked lexical search of many items at once, with common subexpressions evaluated once.

A score is a sum over an item's terms, so items that share terms share parts of their sums.

1. Item texts (each different one once) are split into terms on the driver, block by block.
   Sets of terms shared by at least two items are mined: in every round the pairs found in
   most items become nodes, until no pair stands in two items. Nodes and items form a DAG.
2. One scan over the documents writes, per document, its length and the item terms it holds
   with their counts. Document and term statistics are aggregates of that table.
3. Documents are scored in blocks: a row per term, a row per node (the sum of its two
   halves, made once), and a row per item, the sum of what is left of it. A task keeps the
   best documents of every item and nothing else, so what is shuffled is at most k rows per
   item and task.

Terms are compared as bytes. Items are a query set run against all documents in blocks of
bounded size; no pairs of documents and items are ever written.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from treelens.llm import arrays, frames
from treelens.plans.ordered import top_per_group

ITEM_BYTES = 4 << 20  # text of the items that are scored together
_PAIR_WINDOW = 128  # terms of an item among which pairs are mined, and at most so many rows before the next ones
_MATRIX_BYTES = 32 << 20
#: A-Z to small letters; what is neither letter, digit nor beyond ASCII to a blank.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in parts."""
    for piece in arrays.pieces(text.translate(_TERM_BYTES)):
        yield piece.split()


@dataclass(frozen=True)
class SharedSums:
    """Rows 0 to ``leaves`` - 1 hold terms; then follow nodes, each the sum of two rows before it."""

    leaves: int
    levels: list[tuple[np.ndarray, np.ndarray]]  # rows that are added, level by level
    rest: np.ndarray  # rows that make up the items, one item after the other
    first: np.ndarray  # of each item in ``rest``

    @property
    def rows(self) -> int:
        return self.leaves + sum(len(left) for left, _ in self.levels)

    def evaluate(self, sums: np.ndarray) -> np.ndarray:
        """Scores (items, documents); ``sums`` has its first ``leaves`` rows filled."""
        at = self.leaves
        for left, right in self.levels:
            np.add(sums[left], sums[right], out=sums[at : at + len(left)])
            at += len(left)
        out = np.zeros((len(self.first) - 1, sums.shape[1]), np.int64)
        for item, (lo, hi) in enumerate(zip(self.first[:-1].tolist(), self.first[1:].tolist())):
            if hi > lo:
                sums[self.rest[lo:hi]].sum(axis=0, out=out[item])
        return out


def share(items: list[list[int]], leaves: int) -> SharedSums:
    """Mine sets of terms that items share. ``items`` lists term numbers, repeats included."""
    # The second occurrence of a term in an item is a symbol of its own with the same row.
    number: dict[tuple[int, int], int] = {}
    left: list[set[int]] = []
    for item in items:
        seen: Counter = Counter()
        symbols = set()
        for term in item:
            symbols.add(number.setdefault((term, seen[term]), len(number)))
            seen[term] += 1
        left.append(symbols)
    row = [term for term, _ in number]
    levels = []
    while True:
        holders = defaultdict(set)
        for i, symbols in enumerate(left):
            for symbol in symbols:
                holders[symbol].add(i)
        count: Counter = Counter()
        for symbols in left:
            common = sorted((s for s in symbols if len(holders[s]) > 1), key=lambda s: (-len(holders[s]), s))
            for lo in range(0, len(common), _PAIR_WINDOW):
                count.update(combinations(sorted(common[lo : lo + _PAIR_WINDOW]), 2))
        free = [set(symbols) for symbols in left]
        begin = leaves + sum(len(a) for a, _ in levels)
        pairs = []
        for (a, b), n in sorted(count.items(), key=lambda entry: (-entry[1], entry[0])):
            if n < 2:
                break
            both = [i for i in holders[a] & holders[b] if a in free[i] and b in free[i]]
            if len(both) < 2:
                continue
            node = len(row)
            row.append(begin + len(pairs))
            pairs.append((row[a], row[b]))
            for i in both:
                free[i] -= {a, b}
                left[i] = left[i] - {a, b} | {node}
        if not pairs:
            break
        levels.append((np.array([a for a, _ in pairs]), np.array([b for _, b in pairs])))
    rest = [sorted(row[s] for s in symbols) for symbols in left]
    first = np.cumsum([0, *map(len, rest)])
    return SharedSums(leaves, levels, np.array([r for of_item in rest for r in of_item], np.int64), first)


def _postings(index: dict[bytes, int]):
    """(doc_id, n, terms, counts) of every document."""

    def rows(batches):
        for batch in batches:
            for first, data, offsets in arrays.slices(*arrays.text_bytes(batch.column("text"))):
                raw, size, found = data.tobytes(), [], []
                for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    n, counts = 0, Counter()
                    for words in terms(raw[lo:hi]):
                        n += len(words)
                        counts.update(map(index.get, words))
                    counts.pop(None, None)
                    size.append(n)
                    found.append(counts)
                bounds = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                flat = [pa.array([x for counts in found for x in part(counts)], pa.int64()) for part in (dict.keys, dict.values)]
                lists = [pa.ListArray.from_arrays(bounds, values) for values in (flat[0].cast(pa.int32()), flat[1])]
                ids = batch.column("doc_id").slice(first, len(size))
                yield pa.RecordBatch.from_arrays([ids, pa.array(size, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"])

    return rows


class _Best:
    """The k best documents of every item: higher scores, then smaller ids, missing ids last."""

    def __init__(self, items: int, k: int):
        self.k, self.items = k, items
        self.item = self.score = self.doc = np.zeros(0, np.int64)
        self.missing = np.zeros(0, bool)
        self.least = np.ones(items, np.int64)  # a score below cannot enter

    def add(self, scores: np.ndarray, doc: np.ndarray, missing: np.ndarray) -> None:
        item, at = np.nonzero(scores >= self.least[:, None])
        if not len(item):
            return
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, scores[item, at]])
        doc, missing = np.concatenate([self.doc, doc[at]]), np.concatenate([self.missing, missing[at]])
        order = np.lexsort((doc, missing, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order = order[place < self.k]
        self.item, self.score, self.doc, self.missing = item[place < self.k], score[order], doc[order], missing[order]
        last = place[place < self.k] == self.k - 1
        self.least[self.item[last]] = self.score[last]


def _scored(keys: list[str], plan: SharedSums, weight: np.ndarray, total: tuple[int, int], k: int):
    """The best documents of each item among those of a task."""
    n_docs, n_terms = total

    def rows(batches):
        best = _Best(len(keys), k)
        block = max(1, min(512, _MATRIX_BYTES // (8 * max(plan.rows, 1))))
        sums = np.zeros((plan.rows, block), np.int64)
        for batch in batches:
            size = batch.column("n").to_numpy().astype(np.int64)
            lists = batch.column("terms")
            bounds = np.asarray(lists.offsets, np.int64)
            bounds, term = bounds - bounds[0], np.asarray(lists.flatten(), np.int64)
            tf = np.asarray(batch.column("counts").flatten(), np.int64)
            owner = np.repeat(np.arange(len(size)), np.diff(bounds))
            norm = 75 + 25 * size * n_docs // n_terms
            part = weight[term] * (1_000_000_000 * tf // (1000 * tf + 12 * norm[owner]))
            missing = np.asarray(batch.column("doc_id").is_null())
            doc = np.asarray(batch.column("doc_id").fill_null(0), np.int64)
            for lo in range(0, len(size), block):
                hi = min(lo + block, len(size))
                inside = slice(bounds[lo], bounds[hi])
                here = sums[:, : hi - lo]
                here[: plan.leaves] = 0
                here[term[inside], owner[inside] - lo] = part[inside]
                best.add(plan.evaluate(here), doc[lo:hi], missing[lo:hi])
        ids = pa.array(best.doc, pa.int64(), mask=best.missing)
        names = pa.array(keys, pa.string()).take(pa.array(best.item))
        yield pa.RecordBatch.from_arrays([names, ids, pa.array(best.score, pa.int64())], names=["key", "doc_id", "score"])

    return rows


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def _item_blocks(items: DataFrame, item_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """Different item texts and their keys, in blocks of about ``item_bytes``."""
    texts = frames.stored(items.groupBy("key").agg(F.first("text").alias("text")))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // item_bytes))
    part = F.pmod(F.xxhash64("key"), F.lit(blocks))
    for number in range(blocks):
        yield [(r.key, r.text.encode()) for r in texts.filter(part == number).orderBy("key").collect()]


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score above 0 for every item.

    ``docs`` needs doc_id (any integer type) and text, ``items`` item_id and text; other columns are
    ignored. Equal scores rank by ascending doc_id, missing ids last.

    With N documents that have a term, L terms in them, n terms in a document, df documents
    with a term and tf its occurrences, a term's weight w is floor(1000 ln((2N + 2) / (2df + 1)))
    and a document's norm m is 75 + 25 n N div L. A score sums w ((10^9 tf) div (1000 tf + 12 m))
    over the item's terms, repeats included, in 64-bit integers.

    Null and empty texts have no terms: such items give no rows, such documents are found by
    none and count in no statistic. Repeated rows of ``docs`` are documents of their own. Rows of
    ``items`` alike in id and text are one item; different texts of one id are ranked apart.
    Texts of any length are read in parts. Empty tables give no rows. The tables behind the
    result stay in the shared folder.
    """
    spark = docs.sparkSession
    asked = items.select("item_id", "text").filter("text is not null").withColumn("key", F.sha2("text", 256))
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("text is not null")
    found = []
    for block in _item_blocks(asked, item_bytes):
        index: dict[bytes, int] = {}
        wanted = [[index.setdefault(t, len(index)) for words in terms(text) for t in words] for _, text in block]
        if not index:
            continue
        known = spark.sparkContext.broadcast(index)  # at most item_bytes of terms
        kind = "doc_id bigint, n bigint, terms array<int>, counts array<bigint>"
        postings = frames.stored(plain.mapInArrow(lambda batches: _postings(known.value)(batches), kind))  # noqa: B023
        n_docs, n_terms = postings.filter("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            break
        df = np.zeros(len(index), np.int64)
        for row in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row per item term
            df[row["term"]] = row["count"]
        plan = spark.sparkContext.broadcast((share(wanted, len(index)), weights(n_docs, df)))
        keys, total = [key for key, _ in block], (n_docs, n_terms)
        hits = postings.filter(F.size("terms") > 0)
        found.append(hits.mapInArrow(lambda batches, plan=plan, keys=keys, total=total: _scored(keys, *plan.value, total, k)(batches), "key string, doc_id bigint, score bigint"))
    if not found:
        found = [spark.createDataFrame([], "key string, doc_id bigint, score bigint")]
    rows = found[0]
    for more in found[1:]:
        rows = rows.union(more)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("place")]
    # Documents alike in id and score are told apart by a number only.
    top = top_per_group(frames.stored(rows.withColumn("place", F.monotonically_increasing_id())), ["key"], order, k, salt=["doc_id", "place"])
    asked = asked.select("item_id", "key").distinct()
    return asked.join(top, "key").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op12_ranked_search(spark, sf_dir: str) -> DataFrame:
    return ranked_search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP12_SQL = f"""
WITH item_terms AS (
  SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item_id, term
), doc_terms AS (
  SELECT doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL
), sized AS (
  SELECT doc_id, terms, len(terms) AS n FROM doc_terms WHERE len(terms) > 0
), total AS (
  SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sized
), held AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM sized) GROUP BY doc_id, n, term
), weighed AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, total WHERE term IN (SELECT term FROM item_terms) GROUP BY term, n_docs
), parts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))) AS part
  FROM held JOIN weighed USING (term), total
), scores AS (
  SELECT item_id, doc_id, CAST(sum(times * part) AS BIGINT) AS score FROM item_terms JOIN parts USING (term) GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
