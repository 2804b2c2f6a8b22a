"""Fuzzy line dedup: SimHashes of normalised lines kept in blocks, joined on the blocks, verified.

Lines are normalised as in ``lines``; equal ones collapse. Two lines are linked if
1 - Levenshtein / longer length, in words, reaches ``similarity``, and of every connected group
the first occurrence (by doc_id, then line) stays.

A line's signature is its SimHash, made of blocks: the line is cut into pieces at words, a
block is the SimHash of one piece, and the votes of all pieces together give the SimHash of
the line. A cut stands at a word whose hash is the least within some words on both sides, so
two lines are cut alike wherever they are alike. An edit touches one piece, or the two or
three around a cut it moves; by the pigeonhole principle, lines with more pieces than the
edits between them touch share a block. Blocks are shared in any order of place, so nothing
depends on where in a line the edits are.

Lines of up to nine words, where one edit is allowed, have the SimHashes of the line and of
the line without each of its words as blocks; there any two linked lines share one.

1. One scan files every line: key, place, SimHash and blocks. Lines are joined on equal blocks.
2. One more scan reads the words of the lines that share a block with another.
3. Candidates whose lengths and word parities allow the similarity are verified, whatever the
   distance of their SimHashes as a whole (``max_bits`` below 64 bounds it): every line of a
   block with one of them; then, where a block still holds several components, the lines of
   different components. In a block shared by more than ``hot`` lines these meet on their rarest
   word pairs instead: enough of them, by the pigeonhole principle, that no two similar lines
   miss each other. No line of a block is left out.

Lines have 128-bit keys. Half a key is a line's number while lines are joined; should two lines
ever share a number, they are linked with no other (equal lines still collapse).

Shared blocks are no proof of all links: see ``tests/llm/test_line_blocks.py`` and the README for
the share of links found against the complete search of ``lines.similar_links``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from treelens.llm import arrays, components, frames
from treelens.llm.lines import _LEVEL_BITS, _NORMAL, _PARITIES, _edits, _gram_words, _remove, _texts, _within, _word_points
from treelens.plans.materialize import measured

MAX_BITS = 64  # all: 12 words of which two differ can be 24 bits apart
#: A line meets fewer than so many others in a block, and has some rows of rare word pairs otherwise. With a
#: greater number more and more blocks pass it as the input grows, and rows with them.
HOT_LINES = 64
_CARRIED = 32
_SHORT = 9  # lines of at most so many words are filed without each of their words
#: (fewest words, most words, words on both sides of a cut that have greater hashes). Lines near a border are cut both ways.
SCALES = ((8, 29, 1), (24, 79, 3), (64, None, 5))
_CHUNK, _LANE = 255 * 128, 255
#: The eight bits of a byte as eight bytes.
_SPREAD = np.array([sum((b >> i & 1) << (8 * i) for i in range(8)) for b in range(256)], np.uint64)
_NORMAL_TEXT = bytes(10 if b == 10 else c for b, c in enumerate(_NORMAL))


def _ones(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many hashes of each run have each of the 64 bits; ``starts`` are the first places of the runs.

    Bits are counted as bytes, eight in a number, so a run of more than 255 hashes is counted
    in parts.
    """
    size = np.diff(np.append(starts, len(h)))
    long = np.flatnonzero(size > _LANE)
    more = [np.arange(starts[i] + _LANE, starts[i] + size[i], _LANE) for i in long.tolist()]
    breaks = np.sort(np.concatenate([starts, *more])) if more else starts
    chunks = np.unique(np.searchsorted(breaks, np.arange(0, len(h), _CHUNK)))
    parts = []
    for lo, hi in zip(chunks.tolist(), [*chunks[1:].tolist(), len(breaks)]):
        if lo < hi:
            begin, end = int(breaks[lo]), int(breaks[hi]) if hi < len(breaks) else len(h)
            lanes = _SPREAD[h[begin:end].astype("<u8").view(np.uint8).reshape(-1, 8)]
            parts.append(np.add.reduceat(lanes, breaks[lo:hi] - begin, axis=0))
    counts = np.concatenate(parts).astype("<u8").view(np.uint8).reshape(-1, 64)
    if not more:
        return counts
    out = counts[np.searchsorted(breaks, starts)].astype(np.int32)
    inner = np.concatenate(more)
    np.add.at(out, np.searchsorted(starts, inner, side="right") - 1, counts[np.searchsorted(breaks, inner)].astype(np.int32))
    return out


def _majority(ones: np.ndarray, size: np.ndarray) -> np.ndarray:
    half = (size // 2).astype(ones.dtype)  # counts are bytes only where no size is above 255
    return np.packbits(ones > half[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _cuts(words: np.ndarray, place: np.ndarray, left: np.ndarray, radius: int) -> np.ndarray:
    """Words of least hash among ``radius`` words on both sides of the same line; the first, if several."""
    cut = (place >= radius) & (left > radius)  # ``left`` counts the word itself
    for step in range(1, radius + 1):
        cut[step:] &= words[step:] < words[:-step]
        cut[:-step] &= words[:-step] <= words[step:]
    return cut


def line_signatures(lines: list[bytes], similarity: float = 0.8) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of normalised lines, none of them empty: words, SimHash, blocks, and the blocks' bounds per line.

    Blocks of short lines are odd numbers, those of pieces even. Word hashes of equal value
    only make more candidates, so the quick ones serve.
    """
    length = np.fromiter(map(len, lines), np.int64, len(lines))
    data = np.frombuffer(b"".join(lines), np.uint8)
    starts, ends, first = arrays.word_bounds(data, np.concatenate([[0], np.cumsum(length)]), arrays.WHITE_SPACE)
    words = arrays.range_hashes(data, starts, ends)
    n = np.diff(first)
    owner = np.repeat(np.arange(len(lines)), n)
    place = np.arange(len(words)) - first[owner]
    ones = np.zeros((len(lines), 64), np.int32)
    done = np.zeros(len(lines), bool)
    rows, blocks = [], []
    for number, (least, most, radius) in enumerate(SCALES):
        here = (n >= least) & (n <= (most or n.max(initial=0)))
        inside = here[owner]
        w, own, at = words[inside], owner[inside], place[inside]
        if not len(w):
            continue
        begin = np.flatnonzero(_cuts(w, at, n[own] - at, radius) | (at == 0))
        of_line = own[begin]
        votes = _ones(w, begin)
        size = np.diff(np.append(begin, len(w)))
        lead = np.flatnonzero(np.concatenate([[True], of_line[1:] != of_line[:-1]]))
        ones[of_line[lead]] = np.add.reduceat(votes, lead, axis=0, dtype=np.int32)
        done |= here
        whole = size > radius  # at the ends of a line a piece may be a single common word
        rows.append(of_line[whole])
        blocks.append(arrays.mix(_majority(votes, size)[whole] + np.uint64(number)) & ~np.uint64(1))
    rest = np.flatnonzero(~done)
    if len(rest):
        few = ~done[owner]
        ones[rest] = _ones(words[few], np.cumsum(n[rest]) - n[rest])
    simhash = _majority(ones, n)
    short = (n <= _SHORT) & (_edits(n + 1, similarity) > 0)
    if short.any():
        rows.append(np.flatnonzero(short))
        blocks.append(arrays.mix(simhash[short] ^ n[short].astype(np.uint64)) | np.uint64(1))
        lose = short[owner] & (_edits(n, similarity) > 0)[owner]
        w, own = words[lose], owner[lose]
        bits = np.unpackbits(w.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        rows.append(own)
        blocks.append(arrays.mix(_majority(ones[own] - bits, n[own] - 1) ^ (n[own] - 1).astype(np.uint64)) | np.uint64(1))
    if not rows:
        return n, simhash, np.zeros(0, np.uint64), np.zeros(len(lines) + 1, np.int64)
    row, block = np.concatenate(rows), np.concatenate(blocks)
    order = np.argsort(row, kind="stable")  # pieces stay in the order of the line
    row, block = row[order], block[order]
    return n, simhash, block, np.searchsorted(row, np.arange(len(lines) + 1))


def _normal_lines(batch: pa.RecordBatch):
    """Per slice of texts: rows and numbers of lines that do not normalise to nothing, and those lines."""
    for texts in _texts(batch):
        rows, numbers, lines = [], [], []
        for row, text in texts:
            for number, line in enumerate(text.translate(_NORMAL_TEXT).split(b"\n")):
                if words := line.split():
                    rows.append(row)
                    numbers.append(number)
                    lines.append(b" ".join(words))
        if lines:
            yield np.array(rows), numbers, lines


def _keys(lines: list[bytes]) -> np.ndarray:
    """Both halves of the key of each line."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, lines)), ">i8").astype(np.int64).reshape(-1, 2)


_LINES = "id bigint, rest bigint, doc_id bigint, line bigint, n int, sim bigint, blocks array<bigint>"


def _line_rows(similarity: float):
    """Every line; the first of equal ones in a slice with its words, SimHash and blocks."""

    def rows(batches):
        for batch in batches:
            for row, number, lines in _normal_lines(batch):
                place: dict[bytes, int] = {}
                fresh = np.fromiter((place.setdefault(line, i) == i for i, line in enumerate(lines)), bool, len(lines))
                n, sim, blocks, bounds = line_signatures(list(place), similarity)
                spread = np.zeros(len(lines) + 1, np.int64)
                spread[1:][fresh] = np.diff(bounds)
                at = np.cumsum(fresh) - 1
                keys = _keys(lines)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[:, 0]), pa.array(keys[:, 1]), batch.column("doc_id").take(pa.array(row)), pa.array(number, pa.int64()),
                        pa.array(n[at].astype(np.int32), mask=~fresh), pa.array(arrays.signed(sim)[at], mask=~fresh),
                        pa.ListArray.from_arrays(pa.array(np.cumsum(spread), pa.int32()), pa.array(arrays.signed(blocks))),
                    ],
                    names=["id", "rest", "doc_id", "line", "n", "sim", "blocks"],
                )

    return rows


def _parities(lines: list[bytes]) -> np.ndarray:
    """256 bits of each line: every word turns one."""
    length = np.fromiter(map(len, lines), np.int64, len(lines))
    data = np.frombuffer(b"".join(lines), np.uint8)
    starts, ends, first = arrays.word_bounds(data, np.concatenate([[0], np.cumsum(length)]), arrays.WHITE_SPACE)
    words = arrays.range_hashes(data, starts, ends)
    bit = np.zeros((len(words), 4), np.uint64)
    bit[np.arange(len(words)), ((words >> np.uint64(6)) & np.uint64(3)).astype(np.int64)] = np.uint64(1) << (words & np.uint64(63))
    return np.bitwise_xor.reduceat(bit, first[:-1], axis=0)


def _words_of(wanted: np.ndarray):
    """(id, plain, parities) of the lines that the bitmap ``wanted`` holds, once a slice."""

    def rows(batches):
        for batch in batches:
            for _, _, lines in _normal_lines(batch):
                lines = list(dict.fromkeys(lines))
                ids = _keys(lines)[:, 0]
                at = np.flatnonzero(frames.maybe_in(wanted, ids.view(np.uint64)))
                if not len(at):
                    continue
                found = [lines[i] for i in at.tolist()]
                sides = [pa.array(arrays.signed(np.ascontiguousarray(side))) for side in _parities(found).T]
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(map(_word_points, found), pa.string()), *sides], names=["id", "plain", *_PARITIES])

    return rows


def _filed(lines: DataFrame, hot: int, scratch: frames.Scratch) -> DataFrame:
    """(block, id, crowded, copies): lines under the blocks they share, the exchange by block is made once.

    ``copies`` counts the slices of texts that hold the line. No block and no line of it is left
    out; ``crowded`` only says how its lines are compared.
    """
    rows = lines.select("id", F.explode("blocks").alias("block")).repartition("block")
    hubs = rows.groupBy("block").agg(F.min("id").alias("hub"), F.max("id").alias("last"), F.count(F.lit(1)).alias("lines")).filter("hub < last")
    piece = F.col("block").bitwiseAND(F.lit(1)) == 0  # any two lines under a block of short lines are similar
    hubs = hubs.select("block", ((F.col("lines") > hot) & piece).alias("crowded"))
    shared = rows.join(hubs.hint("shuffle_hash"), "block").groupBy("block", "id", "crowded").agg(F.count(F.lit(1)).alias("copies"))
    return frames.stored(shared, scratch)


def _grams(plain: pa.Array, q: int):
    """Words and grams of q words (a number each) of lines of one character a word: words per line, grams, the line of each."""
    n = np.asarray(pc.utf8_length(plain), np.int64)
    words = np.frombuffer("".join(plain.to_pylist()).encode("utf-32-le"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(n)), n)
    if q == 1:
        return n, arrays.mix(words), owner
    at = np.flatnonzero(owner[1:] == owner[:-1])
    return n, arrays.mix(words[at] << np.uint64(32) | words[at + 1]), owner[at]


def _gram_counts(q: int):
    def rows(batches):
        total = np.zeros(1 << _LEVEL_BITS, np.int64)
        for batch in batches:
            grams = _grams(batch.column("plain"), q)[1]
            total += np.bincount((grams & np.uint64(len(total) - 1)).astype(np.int64), minlength=len(total))
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(total[slots])], names=["slot", "n"])

    return rows


def _rare_rows(levels: np.ndarray, similarity: float):
    """(id, rare): the q * (e + 1) rarest grams of a line, where e edits are allowed. An edit changes q grams at most, so similar lines share one."""
    q = _gram_words(similarity)

    def rows(batches):
        for batch in batches:
            n, grams, owner = _grams(batch.column("plain"), q)
            order = np.lexsort((grams, levels[(grams & np.uint64(len(levels) - 1)).astype(np.int64)], owner))
            grams, owner = grams[order], owner[order]
            place = np.arange(len(owner)) - np.searchsorted(owner, owner)
            taken = place < (q * (_edits(n, similarity) + 1))[owner]
            taken[1:] &= (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
            grams, owner = grams[taken], owner[taken]
            offsets = pa.array(np.searchsorted(owner, np.arange(len(n) + 1)), pa.int32())
            rare = pa.ListArray.from_arrays(offsets, pa.array(arrays.signed(grams)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), rare], names=["id", "rare"])

    return rows


def _rare(plain: DataFrame, similarity: float) -> DataFrame:
    """(id, rare) of the lines ``plain (id, plain)``. Which grams are common decides the cost only; 2**_LEVEL_BITS counts reach the driver at most."""
    counts = plain.select("plain").mapInArrow(_gram_counts(_gram_words(similarity)), "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    counts = counts.select("slot", F.floor(1 + 2 * F.log2("n")).cast("tinyint").alias("level")).toArrow()
    levels = np.zeros(1 << _LEVEL_BITS, np.uint8)
    levels[counts["slot"].to_numpy()] = counts["level"].to_numpy()
    shared = plain.sparkSession.sparkContext.broadcast(levels)
    return plain.mapInArrow(lambda batches: _rare_rows(shared.value, similarity)(batches), "id bigint, rare array<bigint>")


def _near(x: str, y: str, similarity: float, max_bits: int):
    """Lengths, word parities (an edit turns two at most) and SimHashes allow the similarity; short lines need no SimHash."""
    n, m = F.least(f"{x}.n", f"{y}.n"), F.greatest(f"{x}.n", f"{y}.n")
    edits = F.floor(m * (1 - similarity) + 1e-9)
    turned = sum((F.bit_count(F.col(f"{x}.{p}").bitwiseXOR(F.col(f"{y}.{p}"))) for p in _PARITIES), F.lit(0))
    bits = F.bit_count(F.col(f"{x}.sim").bitwiseXOR(F.col(f"{y}.sim")))
    allowed = (m - n <= edits) & (turned <= 2 * edits - (m - n))
    return allowed & ((m <= _SHORT) | (bits <= max_bits)) if max_bits < 64 else allowed


def block_links(filed: DataFrame, texts: DataFrame, similarity: float, max_bits: int, scratch: frames.Scratch) -> DataFrame:
    """Verified links ``(a, b)`` that connect the lines which all pairs within a block would connect.

    A block's lines are first compared with the one of them that shares the most blocks, each of
    its copies counted: in a group of near copies that is a line near its middle, with which
    most others are linked.
    Only in blocks that are in several components after that are the lines of different
    components compared with one another, if lengths, word parities and SimHashes allow it. A
    pair is made in the first of the blocks it shares: a line carries its ``_CARRIED`` first
    blocks, and where two lines have one of them in common, they leave it to that one. Lines of
    crowded blocks meet on their rare grams instead, of which all similar lines share one.
    """
    told = ["id", "n", *_PARITIES, *(["sim"] if max_bits < 64 else [])]  # what ``_near`` asks for
    facts = texts.select("id", F.struct(*told).alias("l"))

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        both = pairs.join(texts.select(F.col("id").alias("a"), F.col("plain").alias("x")), "a").join(texts.select(F.col("id").alias("b"), F.col("plain").alias("y")), "b")
        both = both.withColumn("allowed", F.floor(F.greatest(F.length("x"), F.length("y")) * (1 - similarity) + 1e-9).cast("int"))
        return frames.stored(both.filter(_within(F.col("allowed"))).select("a", "b"), scratch)

    # Rows of lines and blocks carry numbers only; what filters need is joined to pairs of lines.
    of_line = filed.repartition("id")
    degree = of_line.groupBy("id").agg(F.sum("copies").alias("degree"))
    rows = of_line.join(degree.hint("shuffle_hash"), "id").select("block", "id", "degree")
    hubs = rows.groupBy("block").agg(F.max_by("id", F.struct("degree", "id")).alias("hub"))
    # Here every block counts: a pair's first block may have another hub.
    stars = rows.join(hubs.hint("shuffle_hash"), "block").filter("id <> hub").select("id", "hub").distinct()
    stars = stars.join(facts, "id").join(facts.select(F.col("id").alias("hub"), F.col("l").alias("r")), "hub")
    first = verified(stars.filter(_near("l", "r", similarity, max_bits)).select(F.col("id").alias("x"), F.col("hub").alias("y")))
    label = components.components(first, scratch)
    rows = filed.drop("copies").join(label.hint("shuffle_hash"), "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")
    mixed = rows.groupBy("block").agg(F.min("label").alias("p"), F.max("label").alias("q")).filter("p < q").select("block")
    rows = frames.stored(rows.join(mixed.hint("shuffle_hash"), "block"), scratch)
    few = rows.filter("not crowded").drop("crowded")
    low = few.groupBy("id").agg(F.slice(F.array_sort(F.collect_set("block")), 1, _CARRIED).alias("low"))
    known = texts.join(low, "id").select("id", F.struct(*told, "low").alias("l"))
    few = frames.stored(few.join(known, "id").select("block", "l", "label"), scratch)
    other = few.select("block", F.col("l").alias("r"), F.col("label").alias("r_label"))
    elsewhere = F.coalesce(F.array_min(F.array_intersect("l.low", "r.low")) < F.col("block"), F.lit(False))
    pairs = few.join(other, "block").filter((F.col("label") < F.col("r_label")) & _near("l", "r", similarity, max_bits) & ~elsewhere)
    links = first.union(verified(pairs.select(F.col("l.id").alias("x"), F.col("r.id").alias("y"))))
    many = rows.filter("crowded").select("block", "id", "label")
    if many.isEmpty():
        return links
    # Here a line has one row a gram, however many crowded blocks it is in; pairs that share none of these go again.
    member = many.select("id", "label").distinct()
    plain = frames.stored(texts.join(member.select("id"), "id"), scratch)
    rare = frames.stored(_rare(plain.select("id", "plain"), similarity), scratch)
    known = plain.join(rare, "id").select("id", F.struct(*told, "rare").alias("l"))
    with frames.Scratch(filed.sparkSession) as early:
        spread = frames.stored(member.join(rare, "id").select("id", "label", F.explode("rare").alias("gram")), early)
        mixed = spread.groupBy("gram").agg(F.min("label").alias("p"), F.max("label").alias("q")).filter("p < q").select("gram")
        spread = frames.stored(spread.join(mixed.hint("shuffle_hash"), "gram").join(known, "id").select("gram", "label", "l"), scratch)
    other = spread.select("gram", F.col("label").alias("r_label"), F.col("l").alias("r"))
    # A pair is made under the first of the grams it shares.
    once = (F.col("label") < F.col("r_label")) & _near("l", "r", similarity, max_bits) & (F.array_min(F.array_intersect("l.rare", "r.rare")) == F.col("gram"))
    pairs = spread.join(other, "gram").filter(once)
    similar = verified(pairs.select(F.col("l.id").alias("x"), F.col("r.id").alias("y")))
    shared = similar.join(many.select(F.col("id").alias("a"), "block"), "a").join(many.select(F.col("id").alias("b"), "block"), ["b", "block"])
    return links.union(shared.select("a", "b").distinct())


def _dropped_lines(source: DataFrame, similarity: float, max_bits: int, hot: int, scratch: frames.Scratch) -> DataFrame:
    """(doc_id, _dropped): the numbers of the lines that go."""
    with frames.Scratch(source.sparkSession) as early:  # the blocks of all lines are the largest table
        lines = frames.stored(source.mapInArrow(lambda batches: _line_rows(similarity)(batches), _LINES), early)
        filed = _filed(lines, hot, scratch)
        involved = filed.select("id").distinct().withColumn("filed", F.lit(True))
        facts = lines.groupBy("id").agg(F.count(F.lit(1)).alias("copies"), F.min("rest").alias("x"), F.max("rest").alias("y"), F.max("n").alias("n"), F.max("sim").alias("sim"))
        facts = facts.join(involved, "id", "left").filter("filed or copies > 1")
        asked = frames.stored(facts.select("id", "n", "sim", F.expr("coalesce(filed, false) AND x = y").alias("filed")), scratch)
        lines = frames.stored(lines.select("id", "rest", "doc_id", "line").join(asked.select("id"), "id"), scratch)
    linkable = asked.filter("filed").drop("filed")
    wanted = source.sparkSession.sparkContext.broadcast(frames.bitmap(linkable, "id"))
    kind = "id bigint, plain string, " + ", ".join(f"{p} bigint" for p in _PARITIES)
    texts = source.select("text").mapInArrow(lambda batches: _words_of(wanted.value)(batches), kind)
    texts = frames.stored(texts.join(linkable, "id").groupBy("id", "n", "sim", *_PARITIES).agg(F.first("plain").alias("plain")), scratch)
    links = block_links(filed, texts, similarity, max_bits, scratch)
    group = components.components(links, scratch)
    # Equal lines are a group of their own where no link joins them to others.
    places = lines.join(group, "id", "left")
    own = F.when(F.col("component").isNotNull(), F.struct(F.col("component").alias("a"), F.lit(None).cast("bigint").alias("b"))).otherwise(F.struct(F.col("id").alias("a"), F.col("rest").alias("b")))
    places = frames.stored(places.select(own.alias("own"), F.struct("doc_id", "line").alias("place")), scratch)
    least = places.groupBy("own").agg(F.min("place").alias("least"), F.max("place").alias("last")).filter("least < last").drop("last")
    dropped = places.join(least, "own").filter("place <> least")
    return dropped.groupBy("place.doc_id").agg(F.collect_set("place.line").alias("_dropped"))  # at most the lines of the document


def dedupe_similar_lines(docs: DataFrame, similarity: float = 0.8, max_bits: int = MAX_BITS, hot: int = HOT_LINES) -> DataFrame:
    """Remove all but the first occurrence of every group of equal or similar lines.

    ``docs`` needs ``doc_id`` (any integer type) and ``text``. Returns every row and column
    of ``docs`` with the text that is left (``n_chars`` set anew if there), n_lines and
    n_removed. A text all of whose lines go becomes empty; the row stays.

    Null texts stay null and have no lines; lines that normalise to nothing stay. Rows whose
    doc_id is null keep all lines and remove none elsewhere. Lines repeated within a document
    or among rows of one doc_id are occurrences like others; rows of one doc_id keep a line at
    the same number together. Empty tables give no rows. Texts of any length are read whole; a
    candidate pair of lines costs the length of one times the edits allowed, so two similar
    lines of 100,000 words cost 2 * 10**9 steps of one task.

    The texts are joined with the numbers of their lines that go; those are broadcast up to a
    measured 32 MB, beyond it the join shuffles the texts once.
    """
    if not 0 < similarity <= 1:
        raise ValueError("the similarity must lie above 0 and not above 1")
    rest = frames.without(docs, ("n_lines", "n_removed", "_dropped", "_left"))
    source = rest.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("doc_id is not null and text is not null")
    with frames.Scratch(docs.sparkSession) as scratch:
        dropped = _dropped_lines(source, similarity, max_bits, hot, scratch)
        dropped, small = measured(dropped.select(F.col("doc_id").alias("_id"), "_dropped"))
    dropped = F.broadcast(dropped) if small else dropped
    marked = rest.join(dropped, F.col("doc_id").cast("bigint") == F.col("_id"), "left").drop("_id")
    # Only texts that lose a line go to Python.
    touched = F.col("_dropped").isNotNull()
    left = F.when(touched, F.arrow_udf(_remove, "string")(F.when(touched, F.col("text")), "_dropped")).otherwise(F.col("text"))
    n_lines = F.coalesce(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("bigint")
    removed = F.coalesce(F.size("_dropped"), F.lit(0)).cast("bigint")
    out = marked.withColumn("_left", left)
    values = {"text": F.col("_left"), "n_chars": F.length("_left").cast("bigint")}
    return out.select(*(values.get(c, out[f"`{c}`"]).alias(c) for c in rest.columns), n_lines.alias("n_lines"), removed.alias("n_removed"))


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = dedupe_similar_lines(docs)
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))
