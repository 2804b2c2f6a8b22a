"""SimHash near-dedup by an inverted index of positional bytes with count filtering.

Fingerprint: 64 bits from the XXH64 hashes of all word shingles. Two fingerprints that
differ in at most ``max_bits`` bits differ in at most as many of their 8 bytes, so they
share at least ``8 - max_bits`` bytes at the same positions.

Index. A list per (position, byte) would hold one fingerprint in 256 and tallying it
would be quadratic; so the index is kept by sets of ``postings`` positions (three of
eight by default) with the bytes there. The sets are chosen such that any
``8 - max_bits`` positions contain one of them, so no pair that reaches the minimum is
missed. Count filter: a pair that meets is kept only if its tally of equal positional
bytes reaches the guaranteed minimum; then its bit distance is verified.

Exact copies collapse to one fingerprint before. Components are found with
``bucket_components``, so a large group of near copies is not expanded into all pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from treelens.llm import arrays, components, frames

SEED = 42
_CHUNK = 1 << 16


def covering_sets(shared: int, size: int) -> list[tuple[int, ...]]:
    """Position sets of ``size`` such that any ``shared`` of 8 positions contain one of them (greedy)."""
    open_ = {frozenset(c) for c in combinations(range(8), shared)}
    sets = []
    while open_:
        best = max(combinations(range(8), size), key=lambda s: sum(set(s) <= c for c in open_))
        sets.append(best)
        open_ = {c for c in open_ if not set(best) <= c}
    return sets


def _fingerprints(shingle: int):
    import xxhash

    digest = xxhash.xxh64_intdigest

    def of(text: pa.Array) -> pa.Array:
        out = []
        for _, data, offsets in arrays.slices(*arrays.text_bytes(text)):
            raw = data.tobytes()
            for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                words = raw[lo:hi].lower().split()  # bytes: ASCII letters and ASCII white space only
                joined = b" ".join(words)
                length = np.fromiter(map(len, words), np.int64, len(words))
                ends = np.cumsum(length + 1) - 1
                n = min(shingle, len(words))
                begin, end = (ends - length)[: len(words) - n + 1], ends[max(n - 1, 0) :]
                ones = np.zeros(64, np.int64)
                for at in range(0, len(end), _CHUNK):
                    spans = zip(begin[at : at + _CHUNK].tolist(), end[at : at + _CHUNK].tolist())
                    h = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
                    ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
                out.append(np.packbits(2 * ones > len(end), bitorder="little").view("<i8")[0])
        return pa.array(out, pa.int64())

    return of


def fingerprint(text: Column, shingle: int = 4) -> Column:
    """The SimHash of a text as a bigint; null and blank texts give zero."""
    return F.arrow_udf(lambda column: _fingerprints(shingle)(column), "bigint")(text)


def _byte(value: Column, position: int) -> Column:
    return F.shiftright(value, 8 * position).bitwiseAND(F.lit(255))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, postings: int = 3, keep=None) -> DataFrame:
    """Fingerprint and component of every document.

    ``docs`` needs ``doc_id`` (any integer type) and ``text``. Returns every row of
    ``docs`` with its columns (those in ``keep``, all by default; a column named like a
    new one gives way to it) and fingerprint (bigint), component_id (the smallest doc_id
    reachable over links of at most ``max_bits`` differing bits, itself included).

    Null and blank texts have fingerprint zero and link like others. A row whose doc_id is
    null gets the component of its fingerprint, which may be null if no row in it has an id.
    A text of any length is read whole, by one task. Empty tables give no rows.
    """
    if not 0 <= max_bits <= 8 - postings:
        raise ValueError("max_bits may be at most 8 - postings")
    rest = frames.without(docs, ("fingerprint", "component_id"))
    names = rest.columns if keep is None else list(keep)
    marked = frames.stored(rest.withColumn("fingerprint", fingerprint(F.col("text"), shingle)).select(*names, "fingerprint"))
    prints = marked.groupBy("fingerprint").agg(F.min(F.col("doc_id").cast("bigint")).alias("least"))
    minimum = 8 - max_bits

    def match(x: Column, y: Column) -> Column:
        tally = sum((_byte(x, i) == _byte(y, i)).cast("int") for i in range(8))
        return (tally >= minimum) & (F.bit_count(x.bitwiseXOR(y)) <= max_bits)

    keys = []
    for number, chosen in enumerate(covering_sets(minimum, postings)):
        key = F.lit(number).cast("bigint")
        for position in chosen:
            key = key * 256 + _byte(F.col("value"), position)
        keys.append(key)
    nodes = prints.select(F.col("fingerprint").alias("id"), F.col("fingerprint").alias("value"))
    with frames.Scratch(docs.sparkSession) as scratch:
        group = components.bucket_components(nodes, F.array(*keys), match, scratch).withColumnRenamed("id", "fingerprint")
        group = frames.stored(prints.join(group, "fingerprint"), scratch)
        least = group.groupBy("component").agg(F.min("least").alias("component_id"))
        label = frames.stored(group.join(least, "component").select("fingerprint", "component_id"))
    return marked.join(label, "fingerprint").select(*names, "fingerprint", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of each component of ``docs``: that of the smallest doc_id, rows without one last.

    All columns of ``docs`` stay. Of rows that share the id, one of the row number given here
    (and written) stays; rows alike in id and text are one document, of which any stays. Null
    and blank texts form one component. Empty tables give no rows.
    """
    numbered = docs.select(F.monotonically_increasing_id().alias("doc_id"), F.col("doc_id").alias("_id"), "text", F.xxhash64("text").alias("_content"))
    grouped = near_duplicates(numbered, shingle, max_bits, keep=("doc_id", "_id", "_content"))
    place = F.struct(F.col("_id").isNull(), "_id", "doc_id")
    best = frames.stored(grouped.groupBy("component_id").agg(F.min_by(F.struct("_id", "_content"), place).alias("best")))
    same = F.col("_id").eqNullSafe(F.col("best._id")) & (F.col("_content") == F.col("best._content"))
    judged = grouped.join(best, "component_id").select(F.col("_id").alias("doc_id"), "_content", same.alias("kept"))
    left = frames.rejecting(docs, judged.filter("not kept"))
    repeated = frames.stored(judged.filter("kept").groupBy("doc_id", "_content").count().filter("count > 1").drop("count"))
    if repeated.isEmpty():
        return left
    once = repeated.select(F.col("doc_id").alias("_id"), F.col("_content").alias("_hash"))
    again = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    copies = left.join(once, again, "left_semi").withColumn("_hash", F.xxhash64("text")).dropDuplicates(["doc_id", "_hash"])
    return frames.rejecting(left, repeated).union(copies.drop("_hash"))


def op8_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = near_duplicates(docs, keep=("doc_id",))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
