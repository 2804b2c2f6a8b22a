"""BPE encoding and decoding with forced boundaries.

A byte pair that stands side by side inside no token of the vocabulary can never be
merged over, so wherever it occurs the encoding is certain to be cut. Pre-tokens are
split there, every distinct fragment is encoded on its own, and the ids are
concatenated. Decoding lays the bytes of the ids end to end.

Fragments are remembered by their bytes, in two generations of up to ``REMEMBERED`` fragments and
``REMEMBERED_IDS`` ids. Texts and fragments of any length are encoded whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from treelens.llm import arrays, bpe, frames

REMEMBERED, REMEMBERED_IDS = 200_000, 2_000_000


class _Fragments:
    """Ids of known fragments in flat arrays: bytes, ids, and hashes in order to find a fragment by.

    A hash only leads to one fragment, whose bytes then decide; another one of the same hash is not found.
    """

    def __init__(self):
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.data = np.zeros(0, np.uint8)

    def add(self, keys: np.ndarray, flat: np.ndarray, size: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The numbers of the added fragments, whose bytes lie end to end in ``flat``."""
        numbers = np.arange(len(self.length), len(self.length) + len(counts))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(counts) - counts])
        self.length = np.concatenate([self.length, counts])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        self.begin = np.concatenate([self.begin, len(self.data) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.data = np.concatenate([self.data, flat])
        self.keys, first = np.unique(np.concatenate([self.keys, keys]), return_index=True)
        self.numbers = np.concatenate([self.numbers, numbers.astype(np.int32)])[first]
        return numbers

    def find(self, keys: np.ndarray, flat: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Their numbers; -1 for those not known."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.keys) or not len(keys):
            return out
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        number = self.numbers[at].astype(np.int64)
        maybe = np.flatnonzero((self.keys[at] == keys) & (self.size[number] == size))
        begin = np.cumsum(size) - size
        same = arrays.ragged_take(flat, begin[maybe], size[maybe]) == arrays.ragged_take(self.data, self.begin[number[maybe]], size[maybe])
        ends = np.cumsum(size[maybe])
        right = np.concatenate([[0], np.cumsum(same)])
        maybe = maybe[right[ends] - right[ends - size[maybe]] == size[maybe]]
        out[maybe] = number[maybe]
        return out


class _Memory:
    """Fragments met lately, and those met before them; one that comes again moves to the first."""

    def __init__(self):
        self.late, self.before = _Fragments(), _Fragments()

    def numbers(self, vocab: bpe.Vocabulary, flat: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Numbers in ``late`` of different fragments, whose bytes lie end to end in ``flat``."""
        if len(self.late.length) > REMEMBERED or len(self.late.ids) > REMEMBERED_IDS:
            self.late, self.before = _Fragments(), self.late
        begin = np.cumsum(size) - size
        keys = arrays.range_hashes(flat, begin, begin + size)
        known = self.late.find(keys, flat, size)

        def some(which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return keys[which], arrays.ragged_take(flat, begin[which], size[which]), size[which]

        gone = np.flatnonzero(known < 0)
        at = self.before.find(*some(gone))
        again, at = gone[at >= 0], at[at >= 0]
        if len(again):
            length = self.before.length[at]
            known[again] = self.late.add(*some(again), arrays.ragged_take(self.before.ids, self.before.start[at], length), length)
        new = np.flatnonzero(known < 0)
        if len(new):
            part = some(new)
            known[new] = self.late.add(*part, *bpe.merge(vocab, *part[1:]))
        return known


_memory: dict[str, _Memory] = {}


def _encode_slice(path: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids (32 bits: a batch holds many) of all texts of a slice, end to end, and the offsets of each text's ids."""
    vocab = bpe.vocabulary(path)
    begins, special, _ = bpe.pre_tokens(vocab, data, offsets)
    start = np.zeros(len(data) + 1, bool)
    start[1:-1] = vocab.forced[data[:-1], data[1:]] if len(data) else False
    for lo in begins[special >= 0]:
        start[lo : lo + len(vocab.token_bytes[int(special[np.searchsorted(begins, lo)])])] = False
    start[begins] = True
    fragments = np.flatnonzero(start[:-1])
    ends = np.append(fragments[1:], len(data))
    code = np.full(len(fragments), -1, np.int64)
    code[np.searchsorted(fragments, begins)] = special
    _, where, number = bpe.distinct_ranges(data, fragments, ends)
    memory = _memory.setdefault(path, _Memory())

    size = (ends - fragments)[where]
    known = memory.numbers(vocab, arrays.ragged_take(data, fragments[where], size), size)
    memory = memory.late
    which = known[number]
    length = np.where(code >= 0, 1, memory.length[which])
    ids = arrays.ragged_take(memory.ids, memory.start[which], length)
    total = np.concatenate([[0], np.cumsum(length)])
    ids[total[:-1][code >= 0]] = code[code >= 0]
    return ids, total[np.searchsorted(fragments, offsets)]


def _encoder(path: str):
    def of(text: pa.Array) -> pa.Array:
        ids, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for _, data, offsets in arrays.slices(*arrays.text_bytes(text)):
            found, bounds = _encode_slice(path, data, offsets)
            ids.append(found)
            sizes.append(np.diff(bounds))
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids)))

    return of


def _decoder(path: str):
    vocab = bpe.vocabulary(path)

    def of(ids: pa.Array) -> pa.Array:
        out = []
        for value in ids:
            numbers = np.asarray(value.values.fill_null(-1), np.int64) if value.is_valid else np.zeros(0, np.int64)
            numbers = numbers[(numbers >= 0) & (numbers < vocab.size)]
            flat = arrays.ragged_take(vocab.token_flat, vocab.token_start[numbers], vocab.token_length[numbers])
            out.append(flat.tobytes().decode("utf-8", "replace"))
        decoded = pa.array(out, pa.string())
        out.clear()
        arrays.release()
        return decoded

    return of


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``docs`` (all rows and columns; a same-named one gives way) with ids, an array of int.

    ``vocabulary`` is the path of a byte-level BPE file of the tokenizers library, readable
    on every executor. Null and empty texts have no ids. Special strings inside texts
    become their one id; none is added.
    """
    rest = frames.without(docs, ("ids",))
    return rest.withColumn("ids", F.arrow_udf(lambda text: _encoder(vocabulary)(text), "array<int>")("text"))


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` with decoded, the text of ids. Null ids give an empty text; null or unknown ids none."""
    rest = frames.without(encoded, ("decoded",))
    return rest.withColumn("decoded", F.arrow_udf(lambda ids: _decoder(vocabulary)(ids), "string")("ids"))


def _digest(ids: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(np.asarray(v.values, "<u4").tobytes()).hexdigest() for v in ids], pa.string())


def op10_bpe_codec(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


def _round_trip(path: str):
    encode, decode = _encoder(path), _decoder(path)

    def of(text: pa.Array) -> pa.Array:
        ids = encode(text)
        return pa.StructArray.from_arrays([ids.value_lengths(), _digest(ids), decode(ids)], names=["n_tokens", "ids_sha256", "decoded"])

    return of


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Encode, then decode what was encoded: doc_id, n_tokens and digests of ids and decoded text.

    One function does what ``encode`` and ``decode`` do: Spark evaluates functions of a function's
    result apart, so every column made of ids would encode the text again.
    """
    coded = F.arrow_udf(lambda text: _round_trip(vocabulary)(text), "struct<n_tokens: int, ids_sha256: string, decoded: string>")("text")
    rows = docs.select("doc_id", coded.alias("coded"))
    return rows.select(
        "doc_id", F.col("coded.n_tokens").cast("bigint").alias("n_tokens"), F.col("coded.ids_sha256").alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )
