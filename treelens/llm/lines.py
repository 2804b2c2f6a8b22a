"""Complete search for similar lines, and their removal; the yardstick of ``line_blocks``.

Every line is normalised (ASCII letters small, digits to 0, ASCII punctuation and white
space to single blanks) and gets a 128-bit key. Lines that normalise to nothing are never
removed. Equal keys collapse. Two lines are linked if 1 - Levenshtein / longer length, in
words, reaches ``similarity``. Of every connected group the first occurrence (by doc_id,
then line) stays. Words of candidates are read in further scans; a bitmap of fixed size
keeps all other lines in them.

Candidates come in one of two ways. With ``max_bits=None`` every pair that reaches the
similarity is one:

1. Where e edits lie between two lines, at most q * e grams of q words are lost, so that
   among the q * (e + 1) first grams of both, in any order common to all lines, one is
   shared. Grams rare in a sample of documents come first; the order decides the cost only.
2. Of the lines that share such a gram, those stay whose lengths and word parities (256
   bits, at most two of which an edit turns) allow the similarity.
3. Each line is verified against the smallest key of its grams, and components are taken.
   Only grams that still hold several components are paired, across components.

With ``max_bits`` a pair must also have SimHashes within so many bits, which most pairs of
ordinary length at 0.8 to 0.97 have not:

1. Every line gets a 64-bit SimHash of its words. Equal SimHashes collapse. Six blocks of the SimHash, in two groups of three: where at most three bits differ, three
   blocks are untouched, so two of one group are. Each SimHash is therefore filed under
   the six pairs of blocks within a group, and SimHashes are joined on those.
2. Pairs within three bits are verified.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from treelens.llm import arrays, components, frames

MAX_BITS = 3
_SPLIT = np.array([[0, 11, 22], [32, 43, 54]])  # first bits of the blocks
_WIDTH = np.array([[11, 11, 10], [11, 11, 10]])
_NORMAL = bytes(
    48 if 48 <= b <= 57 else b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_VOTES = 1 << 14
_LEVEL_BITS = 20
_SAMPLED = 64  # every so many-th document tells which grams are rare
_PARITIES = ["p0", "p1", "p2", "p3"]


def normalise(line: bytes) -> bytes:
    return b" ".join(line.translate(_NORMAL).split())


def _simhashes(lines: list[bytes]) -> np.ndarray:
    """SimHash of the words of normalised lines, none of them empty."""
    length = np.fromiter(map(len, lines), np.int64, len(lines))
    data = np.frombuffer(b"".join(lines), np.uint8)
    starts, ends, first = arrays.word_bounds(data, np.concatenate([[0], np.cumsum(length)]), arrays.WHITE_SPACE)
    h = arrays.range_hashes(data, starts, ends)
    ones = np.zeros((len(lines), 64), np.int64)
    owner = np.repeat(np.arange(len(lines)), np.diff(first))
    for at in range(0, len(h), _VOTES):
        bits = np.unpackbits(h[at : at + _VOTES].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[at : at + _VOTES]
        begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        ones[own[begin]] += np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
    majority = 2 * ones > np.diff(first)[:, None]
    return np.packbits(majority, axis=1, bitorder="little").view("<u8").ravel()


def _texts(batch: pa.RecordBatch):
    """(row, text bytes) of a batch; null counts as empty."""
    for begin, data, offsets in arrays.slices(*arrays.text_bytes(batch.column("text"))):
        raw = data.tobytes()
        yield [(begin + i, raw[lo:hi]) for i, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist()))]


def _line_rows(batches, simhash: bool = True):
    for batch in batches:
        for texts in _texts(batch):
            rows, numbers, normal = [], [], []
            for row, text in texts:
                for number, line in enumerate(text.split(b"\n")):
                    if plain := normalise(line):
                        rows.append(row)
                        numbers.append(number)
                        normal.append(plain)
            if normal:
                keys = pa.array(map(xxhash.xxh3_128_digest, normal), pa.binary())
                columns = {"key": keys, "doc_id": batch.column("doc_id").take(pa.array(rows)), "line": pa.array(numbers, pa.int64())}
                if simhash:
                    columns["sim"] = pa.array(arrays.signed(_simhashes(normal).astype(np.uint64)))
                yield pa.RecordBatch.from_pydict(columns)


def _edits(n: np.ndarray, similarity: float) -> np.ndarray:
    """Edits allowed between lines the longer of which has n words."""
    return np.floor(n * (1 - similarity) + 1e-9).astype(np.int64)


def _gram_words(similarity: float) -> int:
    """Two words a gram where any two linked lines share one, else single words."""
    return 2 if similarity >= 0.8 else 1


def _grams(lines: list[bytes], q: int):
    """Of normalised lines, none of them empty: word hashes, first words, gram hashes and the line of each gram."""
    length = np.fromiter(map(len, lines), np.int64, len(lines))
    data = np.frombuffer(b"".join(lines), np.uint8)
    starts, ends, first = arrays.word_bounds(data, np.concatenate([[0], np.cumsum(length)]), arrays.WHITE_SPACE)
    words = arrays.range_hashes(data, starts, ends)
    grams = arrays.Grams(words, first)
    at = grams.starts(q)
    return words, first, grams.hashes(at, q), np.repeat(np.arange(len(lines)), np.diff(first))[at]


def _normal_lines(batches):
    """Distinct normalised lines of a slice of texts, by key."""
    for batch in batches:
        for texts in _texts(batch):
            normal = [plain for _, text in texts for line in text.split(b"\n") if (plain := normalise(line))]
            if normal:
                yield dict(zip(map(xxhash.xxh3_128_digest, normal), normal))


def _gram_counts(q: int):
    def rows(batches):
        total = np.zeros(1 << _LEVEL_BITS, np.int64)
        for found in _normal_lines(batches):
            h = _grams(list(found.values()), q)[2]
            total += np.bincount((h & np.uint64(len(total) - 1)).astype(np.int64), minlength=len(total))
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(total[slots])], names=["slot", "n"])

    return rows


def _gram_levels(docs: DataFrame, q: int) -> np.ndarray:
    """How common grams are, by their lowest bits: log2 of the count in the sample; 2**_LEVEL_BITS bytes."""
    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(_SAMPLED)) == 0).select("text")
    counts = sample.mapInArrow(lambda batches: _gram_counts(q)(batches), "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << _LEVEL_BITS, np.uint8)
    out[counts["slot"].to_numpy(np.int64)] = 1 + np.log2(counts["n"].to_numpy(np.int64)).astype(np.uint8)
    return out


def _gram_rows(levels: np.ndarray, similarity: float):
    q = _gram_words(similarity)

    def rows(batches):
        for found in _normal_lines(batches):
            words, first, grams, owner = _grams(list(found.values()), q)
            n = np.diff(first)
            order = np.lexsort((grams, levels[(grams & np.uint64(len(levels) - 1)).astype(np.int64)], owner))
            grams, owner = grams[order], owner[order]
            place = np.arange(len(owner)) - np.searchsorted(owner, owner)
            taken = (place < q * (_edits(n, similarity) + 1)[owner]) & (_edits(n + 1, similarity) > 0)[owner]
            taken[1:] &= (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
            grams, owner = grams[taken], owner[taken]
            bit = np.zeros((len(words), 4), np.uint64)
            bit[np.arange(len(words)), ((words >> np.uint64(6)) & np.uint64(3)).astype(np.int64)] = np.uint64(1) << (words & np.uint64(63))
            parity = np.bitwise_xor.reduceat(bit, first[:-1], axis=0)
            offsets = np.searchsorted(owner, np.arange(len(n) + 1)).astype(np.int32)
            own = pa.ListArray.from_arrays(pa.array(offsets), pa.array(arrays.signed(grams)))
            sides = [pa.array(arrays.signed(np.ascontiguousarray(parity[:, i]))) for i in range(4)]
            batch = pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(n, pa.int32()), *sides, own], names=["key", "n", *_PARITIES, "grams"])
            yield batch.filter(pa.array(np.diff(offsets) > 0))

    return rows


def _word_points(line: bytes) -> str:
    """One character per word, so that the edit distance of strings counts words.

    Two different words share their character once in about a million.
    """
    return "".join(chr(0x10000 + xxhash.xxh3_64_intdigest(word) % 0x100000) for word in line.split())


def _low(key: bytes) -> int:
    return int.from_bytes(key[:8], "big")


def _candidate_texts(bits: np.ndarray):
    def rows(batches):
        for batch in batches:
            for texts in _texts(batch):
                normal = [plain for _, text in texts for line in text.split(b"\n") if (plain := normalise(line))]
                keys = list(map(xxhash.xxh3_128_digest, normal))
                maybe = np.flatnonzero(frames.maybe_in(bits, np.fromiter(map(_low, keys), np.uint64, len(keys))))
                found = {keys[i]: _word_points(normal[i]) for i in maybe.tolist()}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.string())], names=["key", "plain"]
                )

    return rows


def _remove(text: pa.Array, dropped: pa.Array) -> pa.Array:
    out = []
    for value, lines in zip(text, dropped):
        if not lines.is_valid:
            out.append(value.as_py())
            continue
        gone = set(lines.as_py())
        out.append("\n".join(line for i, line in enumerate(value.as_py().split("\n")) if i not in gone))
    return pa.array(out, pa.string())


def _block_keys():
    sim = F.col("sim")
    keys = []
    for group in range(2):
        for x, y in ((0, 1), (0, 2), (1, 2)):
            part = lambda i: F.shiftrightunsigned(sim, int(_SPLIT[group, i])).bitwiseAND(F.lit((1 << int(_WIDTH[group, i])) - 1))  # noqa: B023, E731
            keys.append((part(x) * (1 << int(_WIDTH[group, y])) + part(y)) * 8 + (3 * group + x + y))
    return keys


def line_links(lines: DataFrame, docs: DataFrame, similarity: float, scratch: frames.Scratch) -> DataFrame:
    """Verified links ``(a, b)`` between keys of ``lines (key, sim)``, one row per distinct key.

    They connect exactly the lines that all links would connect, without forming all pairs
    of a group. Lines of one SimHash are first verified against the smallest key among
    them, and near SimHashes by their smallest keys. Where all of that holds, the lines
    are connected already; only where a check fails are the lines of the SimHash, or of
    the two, paired with one another. Tables written for it live in ``scratch``.
    """
    sims = frames.stored(lines.groupBy("sim").agg(F.min("key").alias("hub"), F.max("key").alias("last")), scratch)
    filed = sims.select("sim", F.explode(F.array(*_block_keys())).alias("block"))
    left, right = filed.alias("l"), filed.alias("r")
    near = F.bit_count(F.col("l.sim").bitwiseXOR(F.col("r.sim"))) <= MAX_BITS
    pairs = left.join(right, (F.col("l.block") == F.col("r.block")) & (F.col("l.sim") < F.col("r.sim")) & near)
    pairs = pairs.select(F.col("l.sim").alias("sim_l"), F.col("r.sim").alias("sim_r")).distinct()
    hubs = sims.select("sim", "hub")
    pairs = frames.stored(pairs.join(hubs.toDF("sim_l", "hub_l"), "sim_l").join(hubs.toDF("sim_r", "hub_r"), "sim_r"), scratch)
    several = sims.filter("hub <> last").select("sim")
    involved = pairs.select(F.col("sim_l").alias("sim")).union(pairs.select("sim_r")).union(several).distinct()
    asked = frames.stored(lines.join(involved, "sim").select("key", "sim"), scratch)

    low = F.conv(F.hex(F.substring("key", 1, 8)), 16, -10).cast("bigint")
    bits = docs.sparkSession.sparkContext.broadcast(frames.bitmap(asked.select(low.alias("low")), "low"))
    texts = docs.select("text").mapInArrow(lambda batches: _candidate_texts(bits.value)(batches), "key binary, plain string")
    texts = frames.stored(texts.join(asked.select("key"), "key", "left_semi").groupBy("key").agg(F.first("plain").alias("plain")), scratch)

    def verified(candidates: DataFrame) -> DataFrame:
        both = candidates.join(texts.toDF("a", "x"), "a").join(texts.toDF("b", "y"), "b")
        allowed = F.floor(F.greatest(F.length("x"), F.length("y")) * (1 - similarity) + 1e-9).cast("int")
        both = both.withColumn("allowed", allowed)
        close = (F.abs(F.length("x") - F.length("y")) <= F.col("allowed")) & _within(F.col("allowed"))
        return frames.stored(both.withColumn("linked", close).drop("x", "y", "allowed"), scratch)

    same = asked.join(sims.filter("hub <> last"), "sim").filter("key <> hub").select("sim", F.col("hub").alias("a"), F.col("key").alias("b"))
    same = verified(same)
    across = verified(pairs.select(F.col("hub_l").alias("a"), F.col("hub_r").alias("b"), "sim_l", "sim_r"))
    broken = same.filter("not linked").select("sim").distinct()
    doubtful = across.filter("not linked").select("sim_l", "sim_r")
    doubtful = doubtful.union(across.join(broken, F.col("sim_l") == F.col("sim"), "left_semi").select("sim_l", "sim_r"))
    doubtful = doubtful.union(across.join(broken, F.col("sim_r") == F.col("sim"), "left_semi").select("sim_l", "sim_r"))
    doubtful = doubtful.union(broken.select(F.col("sim").alias("sim_l"), F.col("sim").alias("sim_r"))).distinct()
    rest = doubtful.join(asked.toDF("a", "sim_l"), "sim_l").join(asked.toDF("b", "sim_r"), "sim_r").filter("sim_l <> sim_r or a < b")
    rest = verified(rest.select("a", "b").join(across.select("a", "b").union(same.select("a", "b")), ["a", "b"], "left_anti"))
    parts = [part.filter("linked").select("a", "b") for part in (same, across, rest)]
    return parts[0].union(parts[1]).union(parts[2])


def similar_links(docs: DataFrame, similarity: float, scratch: frames.Scratch) -> DataFrame:
    """Links ``(a, b)`` between keys that connect exactly the lines that all pairs of at least ``similarity`` connect."""
    levels = docs.sparkSession.sparkContext.broadcast(_gram_levels(docs, _gram_words(similarity)))
    kind = "key binary, n int, p0 bigint, p1 bigint, p2 bigint, p3 bigint, grams array<bigint>"
    facts = docs.select("text").mapInArrow(lambda batches: _gram_rows(levels.value, similarity)(batches), kind)
    facts = frames.stored(facts.groupBy("key").agg(*(F.first(c).alias(c) for c in ("n", *_PARITIES, "grams"))), scratch)
    head = facts.drop("grams")
    rows = facts.select("key", F.explode("grams").alias("gram"))
    hubs = rows.groupBy("gram").agg(F.min("key").alias("hub"), F.max("key").alias("last")).filter("hub < last").drop("last")
    filed = frames.stored(rows.join(hubs, "gram"), scratch)

    def near(x: str, y: str):
        n, m = F.least(f"{x}.n", f"{y}.n"), F.greatest(f"{x}.n", f"{y}.n")
        edits = F.floor(m * (1 - similarity) + 1e-9)
        turned = sum((F.bit_count(F.col(f"{x}.{p}").bitwiseXOR(F.col(f"{y}.{p}"))) for p in _PARITIES), F.lit(0))
        return (m - n <= edits) & (turned <= 2 * edits - (m - n))

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = frames.stored(pairs, scratch)
        asked = frames.stored(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct(), scratch)
        low = F.conv(F.hex(F.substring("key", 1, 8)), 16, -10).cast("bigint")
        bits = docs.sparkSession.sparkContext.broadcast(frames.bitmap(asked.select(low.alias("low")), "low"))
        texts = docs.select("text").mapInArrow(lambda batches: _candidate_texts(bits.value)(batches), "key binary, plain string")
        texts = frames.stored(texts.join(asked, "key", "left_semi").groupBy("key").agg(F.first("plain").alias("plain")), scratch)
        both = pairs.join(texts.toDF("a", "x"), "a").join(texts.toDF("b", "y"), "b")
        both = both.withColumn("allowed", F.floor(F.greatest(F.length("x"), F.length("y")) * (1 - similarity) + 1e-9).cast("int"))
        return frames.stored(both.filter(_within(F.col("allowed"))).select("a", "b"), scratch)

    stars = filed.filter("key <> hub").select(F.col("hub").alias("a"), F.col("key").alias("b")).distinct()
    stars = stars.join(head.alias("l"), F.col("a") == F.col("l.key")).join(head.alias("r"), F.col("b") == F.col("r.key")).filter(near("l", "r"))
    first = verified(stars.select("a", "b"))
    label = components.components(first, scratch).withColumnRenamed("id", "key")
    known = head.join(label, "key", "left").withColumn("label", F.coalesce("component", "key")).drop("component")
    rows = frames.stored(filed.drop("hub").join(known, "key"), scratch)
    mixed = rows.groupBy("gram").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("gram")
    rows = frames.stored(rows.join(mixed, "gram"), scratch)
    left, right = rows.alias("l"), rows.alias("r")
    pairs = left.join(right, (F.col("l.gram") == F.col("r.gram")) & (F.col("l.label") < F.col("r.label")) & near("l", "r"))
    return first.union(verified(pairs.select(F.col("l.key").alias("a"), F.col("r.key").alias("b")).distinct()))


def _within(allowed):
    """Levenshtein(x, y) <= allowed, with bands that widen until one decides: cost is length times distance."""

    def reached(bound):
        return F.call_function("levenshtein", F.col("x"), F.col("y"), F.least(allowed, F.lit(bound))) >= 0

    decided = F.call_function("levenshtein", F.col("x"), F.col("y"), allowed) >= 0
    for bound in (256, 32, 4):
        decided = F.when(reached(bound), True).when(allowed <= bound, False).otherwise(decided)
    return decided


def _dropped_lines(source: DataFrame, similarity: float, max_bits: int | None, scratch: frames.Scratch) -> DataFrame:
    """(doc_id, _dropped): the numbers of the lines that go."""
    simhash = max_bits is not None
    kind = "key binary, doc_id bigint, line bigint" + ", sim bigint" * simhash
    lines = frames.stored(source.mapInArrow(lambda batches: _line_rows(batches, simhash), kind), scratch)
    place = F.struct("doc_id", "line")
    sim = [F.first("sim").alias("sim")] if simhash else []
    distinct = frames.stored(lines.groupBy("key").agg(*sim, F.min(place).alias("first"), F.count(F.lit(1)).alias("n")), scratch)
    links = line_links(distinct.select("key", "sim"), source, similarity, scratch) if simhash else similar_links(source, similarity, scratch)
    group = components.components(links, scratch).withColumnRenamed("id", "key")
    grouped = frames.stored(distinct.join(group, "key", "left").select("key", "first", "n", F.coalesce("component", "key").alias("component"), F.col("component").isNotNull().alias("linked")), scratch)
    least = grouped.filter("linked").groupBy("component").agg(F.min("first").alias("least"))
    keep = grouped.filter("linked").join(least, "component").select("key", "least")
    keep = keep.union(grouped.filter("not linked and n > 1").select("key", F.col("first").alias("least")))
    dropped = lines.join(keep, "key").filter(F.struct("doc_id", "line") != F.col("least"))
    return dropped.groupBy("doc_id").agg(F.collect_set("line").alias("_dropped"))  # at most the lines of the document


def dedupe_lines(docs: DataFrame, similarity: float = 0.8, max_bits: int | None = MAX_BITS) -> DataFrame:
    """Remove all but the first occurrence of every group of equal or similar lines.

    ``max_bits=None`` links all lines that reach ``similarity``. The default, 3 and the
    only other value, links only those among them whose SimHashes differ in at most 3 bits.

    ``docs`` needs ``doc_id`` (any integer type) and ``text``. Returns every row and column
    of ``docs`` with the text that is left (``n_chars`` set anew if there), n_lines and
    n_removed. A text all of whose lines go becomes empty; the row stays.

    Null texts stay null and have no lines. Rows whose doc_id is null keep all lines and
    remove none elsewhere. Lines repeated within a document or among rows of one doc_id
    are occurrences like others; rows of one doc_id keep a line at the same number together.
    """
    if max_bits not in (None, MAX_BITS):
        raise ValueError(f"max_bits is None or {MAX_BITS}")
    if not 0 < similarity <= 1:
        raise ValueError("the similarity must lie above 0 and not above 1")
    rest = frames.without(docs, ("n_lines", "n_removed", "_dropped", "_left"))
    source = rest.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("doc_id is not null and text is not null")
    with frames.Scratch(docs.sparkSession) as scratch:
        dropped = frames.stored(_dropped_lines(source, similarity, max_bits, scratch))
    marked = rest.join(dropped.withColumnRenamed("doc_id", "_id"), F.col("doc_id").cast("bigint") == F.col("_id"), "left").drop("_id")
    left = F.when(F.col("_dropped").isNotNull(), F.arrow_udf(_remove, "string")("text", "_dropped")).otherwise(F.col("text"))
    n_lines = F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("bigint")
    removed = F.coalesce(F.size("_dropped"), F.lit(0)).cast("bigint")
    out = marked.withColumn("_left", left)
    values = {"text": F.col("_left"), "n_chars": F.length("_left").cast("bigint")}
    return out.select(*(values.get(c, out[f"`{c}`"]).alias(c) for c in rest.columns), n_lines.alias("n_lines"), removed.alias("n_removed"))
