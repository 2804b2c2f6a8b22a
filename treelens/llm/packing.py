"""Cost-balanced packing of documents into token sequences of one length.

A sequence costs ``linear * n + quadratic * n * n`` for every piece of n tokens it holds
(attention reaches over one piece). Documents are taken by descending cost; each goes to the
sequence of least cost that still has room for it. A document for which no sequence has room
is cut: it fills the one of least cost, and its rest takes its place in the order again. What
a document holds beyond whole sequences is packed this way; its whole sequences stand alone.

The sequences of a block have room for exactly its tokens, so all of them end up full. Blocks
are made inside a partition, from rows in their order, and pass on less than one sequence of
tokens; what the last one leaves goes into sequences whose lengths are different powers of
two. There is no shuffle, and no padding: at most log2(length) sequences of a partition are
shorter than the others. Balance is over the sequences of a block, some 500 by default.

Tokens come from a vocabulary of the tokenizers library that drops white space. Words between
ASCII white space are therefore encoded apart, each different one once as long as it is
remembered.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from treelens.llm import arrays

LENGTH, END = 4096, 2
BLOCK_TOKENS = 1 << 21
LINEAR, QUADRATIC = 4096.0, 1.0
_SLICE = 1 << 20
_CALL = 1 << 16  # bytes of words encoded by one call
_MEMORY, _LONG_WORD = 700_000, 64
#: Small ASCII and Latin letters, digits and marks, of which no Unicode version and no normal form makes anything else.
_COUNTED = regex.compile(r"[ -@\[-~\u00a1-\u00ac\u00ae-\u012f\u0131-\u024f]*")
#: What the vocabulary file splits words by (a fixed value).
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PRE_TOKENS = regex.compile(_SPLIT)
_SEQUENCE_BITS = 33  # of a sequence id, below the number of the partition


class WordEncoder:
    """Token ids of texts, by words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        drops = steps[0].get("type") == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
        plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"])
        if not drops or not plain:
            raise ValueError(f"{path} is no vocabulary that drops white space")
        #: Small letters: what may be a special token is left as it is.
        self.special = [t["content"].encode().lower() for t in spec["added_tokens"]]
        self.counted = drops and steps[0]["pattern"].get("Regex") == _SPLIT
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        vocab, suffix = self.library.get_vocab(), spec["model"]["end_of_word_suffix"]
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if suffix and token.endswith(suffix)]] = True
        #: Words met lately, and those met before them; a word that comes again moves to the first.
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _bounds(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words set apart by blanks, and where each word's ids end.

        A word's pre-tokens are counted, and its last one's last token ends a word of the
        vocabulary. Where characters are not certain to be counted alike here and in the
        library, the places of the tokens tell to which words they belong.
        """
        joined = " ".join(texts)
        if self.counted and _COUNTED.fullmatch(joined):
            ids = np.array(self.library.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            last = np.flatnonzero(self.ends[ids]) + 1
            count = np.cumsum([1 if t.isalpha() else len(_PRE_TOKENS.findall(t)) for t in texts])
            if len(last) == count[-1] and last[-1] == len(ids):
                return ids, last[count - 1]
        found = self.library.encode(joined, add_special_tokens=False)
        ids, start = np.array(found.ids, "<u4"), np.array([lo for lo, _ in found.offsets], np.int64)
        return ids, np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]))

    def _encode(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of each word."""
        out, run, size = {}, [], 0
        for word in chain(words, [None]):
            if run and (word is None or size > _CALL):
                ids, ends = self._bounds([w.decode("utf-8") for w in run])
                raw, ends = ids.tobytes(), (4 * ends).tolist()
                out |= {w: raw[lo:hi] for w, lo, hi in zip(run, chain([0], ends), ends)}
                run, size = [], 0
            if word is not None:
                run.append(word)
                size += len(word)
        return out

    def of_slice(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        small = [text.lower() for text in texts]  # bytes: ASCII letters only
        if not any(s in text for text in small for s in self.special):
            texts = small
        words = [text.split() for text in texts]  # bytes: ASCII white space only
        known, older = self.known, self.older
        new = [w for w in set(chain.from_iterable(words)) if w not in known]
        if older:
            known |= {w: older[w] for w in new if w in older}
            new = [w for w in new if w not in known]
        known |= self._encode(new)
        out = [b"".join(map(known.__getitem__, of_text)) for of_text in words]
        for word in [w for w in new if len(w) > _LONG_WORD]:
            del known[word]
        if len(known) > _MEMORY:
            self.known, self.older = {}, known
        return out

    def texts(self, column) -> list[np.ndarray]:
        """Ids of each text of an Arrow column; null counts as empty."""
        out = []
        for _, data, offsets in arrays.slices(*arrays.text_bytes(column), _SLICE):
            raw = data.tobytes()
            if len(offsets) > 2:
                parts = self.of_slice([raw[lo:hi] for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
            else:  # one text, maybe a very long one
                parts = [b"".join(self.of_slice([piece])[0] for piece in arrays.pieces(raw))]
            out += [np.frombuffer(ids, "<u4") for ids in parts]
        return out


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def assign(lengths: Sequence[int], rooms: Sequence[int], linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset); the rooms together hold at most all lengths.

    Documents of equal length are taken in their order, sequences of equal cost in theirs. Stops
    when all rooms are full.
    """
    rooms = np.array(rooms, np.int64)
    left, cost = rooms.copy(), np.zeros(len(rooms))
    todo = [(-n, i, 0) for i, n in enumerate(lengths) if n]
    heapq.heapify(todo)
    out, open_ = [], int(left.sum())
    while todo and open_:
        size, document, start = heapq.heappop(todo)
        size = -size
        best = int(np.argmin(np.where(left >= size, cost, np.inf)))
        if left[best] < size:
            best = int(np.argmin(np.where(left > 0, cost, np.inf)))
            rest = size - int(left[best])
            size -= rest
            heapq.heappush(todo, (-rest, document, start + size))
        out.append((document, start, size, best, int(rooms[best] - left[best])))
        left[best] -= size
        open_ -= size
        cost[best] += linear * size + quadratic * size * size
    return out


def _powers(n: int) -> list[int]:
    return [1 << b for b in reversed(range(n.bit_length())) if n >> b & 1]


class _Packer:
    """Blocks of one partition."""

    def __init__(self, keep_schema: pa.Schema, length: int, linear: float, quadratic: float):
        self.schema, self.length, self.costs = keep_schema, length, (linear, quadratic)
        self.base, self.used = TaskContext.get().partitionId() << _SEQUENCE_BITS, 0
        self.rests: list = []  # (row, place of the ids in their document, ids, tokens of the document)
        self.tokens = 0

    def add(self, row: tuple, ids: np.ndarray, out: list) -> None:
        whole = len(ids) - len(ids) % self.length
        for start in range(0, whole, self.length):
            out.append((row, start, ids[start : start + self.length], len(ids), self.base + self.used, 0))
            self.used += 1
        if whole < len(ids):
            self.rests.append((row, whole, ids[whole:].copy(), len(ids)))
            self.tokens += len(ids) - whole

    def pack(self, out: list, last: bool) -> None:
        rooms = [self.length] * (self.tokens // self.length) + (_powers(self.tokens % self.length) if last else [])
        reached = [0] * len(self.rests)
        done = assign([len(r[2]) for r in self.rests], rooms, *self.costs)
        for document, start, size, sequence, offset in done:
            row, base, ids, n = self.rests[document]
            out.append((row, base + start, ids[start : start + size], n, self.base + self.used + sequence, offset))
            reached[document] = start + size
        self.used += len(rooms)
        self.rests = [(row, base + r, ids[r:], n) for (row, base, ids, n), r in zip(self.rests, reached) if r < len(ids)]
        self.tokens = sum(len(r[2]) for r in self.rests)

    def batch(self, out: list) -> pa.RecordBatch:
        rows = list(zip(*(r[0] for r in out))) if len(self.schema) else []
        kept = [pa.array(values, f.type) for values, f in zip(rows, self.schema)]
        columns = [
            pa.array([r[1] for r in out], pa.int64()),
            pa.array([len(r[2]) for r in out], pa.int64()),
            pa.array([r[2].tobytes() for r in out], pa.binary()),
            *(pa.array([r[i] for r in out], pa.int64()) for i in (3, 4, 5)),
        ]
        return pa.RecordBatch.from_arrays([*kept, *columns], names=[*self.schema.names, *ADDED])


ADDED = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def pack(
    docs: DataFrame,
    path: str,
    keep: Sequence[str] = ("doc_id",),
    length: int = LENGTH,
    end: int = END,
    block_tokens: int = BLOCK_TOKENS,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
) -> DataFrame:
    """One row per piece of a document: the columns in ``keep``, start, length, ids, doc_tokens, sequence_id, offset.

    ``docs`` needs ``text``. ``ids`` holds the piece's tokens as little-endian unsigned 32-bit
    integers; ``end`` closes every document and counts as a token of it. A sequence is made of
    the pieces with its ``sequence_id`` by ``offset``, without gaps; its length is ``length`` or
    a power of two below.

    Every row is a document of its own, repeated ids or not. Null and empty texts are the one
    token ``end``. A text of any length is encoded in parts and held as ids. Columns of
    ``docs`` that are not in ``keep`` are ignored, whatever their names. Empty tables give no rows.
    """
    if block_tokens < length:
        raise ValueError("a block holds one sequence at least")
    taken = {c.lower() for c in ADDED} & {c.lower() for c in keep}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are made here")
    chosen = docs.select(*keep, F.col("text").cast("string").alias("_text"))

    def rows(batches):
        encoder, packer = word_encoder(path), None
        for batch in batches:
            names = batch.schema.names[:-1]
            kept = [batch.column(i) for i in range(len(names))]
            packer = packer or _Packer(pa.schema(list(batch.schema)[:-1]), length, linear, quadratic)
            at = 0
            for lo, data in _row_slices(batch):
                out = []
                for ids in encoder.texts(data):
                    packer.add(tuple(c[at].as_py() for c in kept), np.append(ids, np.uint32(end)), out)
                    at += 1
                    if packer.tokens >= block_tokens:
                        packer.pack(out, last=False)
                if out:
                    yield packer.batch(out)
        if packer is not None:
            out = []
            packer.pack(out, last=True)
            if out:
                yield packer.batch(out)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema][:-1]
    added = "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    return chosen.mapInArrow(rows, ", ".join([*fields, added]))


def _row_slices(batch: pa.RecordBatch):
    """Texts of a batch, about 4 MB at a time."""
    _, offsets = arrays.text_bytes(batch.column(batch.num_columns - 1))
    text = batch.column(batch.num_columns - 1)
    first, n = 0, len(text)
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + 4 * _SLICE, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, text.slice(first, last - first)
        first = last


def op13_sequence_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
