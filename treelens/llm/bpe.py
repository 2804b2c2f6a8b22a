"""Byte-level BPE on flat arrays: pre-tokens, and rank-synchronous merging.

Reads the vocabulary file of the tokenizers library (byte-level BPE without normalizer
or prefix space). Texts are split into pre-tokens by array operations on their code
points; distinct pre-tokens are merged together as ragged arrays. Whether a code
point counts as letter, number or white space is asked of the library itself, one
distinct code point at a time, so its Unicode version decides.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import numpy as np

from treelens.llm import arrays

_OTHER, _LETTER, _NUMBER, _SPACE, _UNKNOWN = range(5)
_NO_RANK = np.iinfo(np.int64).max
LONG_SEQUENCE = 512
#: Second and third letters of the contractions that follow an apostrophe (fixed values).
_SHORT_ENDINGS, _LONG_ENDINGS = "stmd", ("re", "ve", "ll")


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for the 256 bytes in a byte-level vocabulary."""
    printable = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tables of one vocabulary file."""

    def __init__(self, path: str):
        from tokenizers.pre_tokenizers import ByteLevel

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"]
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or spec["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"]:
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("only plain added tokens are supported")
        alphabet = byte_alphabet()
        vocab = model["vocab"]
        self.token_bytes = {i: bytes(alphabet[c] for c in token) for token, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        self.size = max(self.token_bytes) + 1
        self.byte_id = np.zeros(256, np.int64)
        for char, byte in alphabet.items():
            self.byte_id[byte] = vocab[char]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        code = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(code, kind="stable")
        self.pair_code, self.pair_rank = code[order], order
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        flat = [self.token_bytes.get(i, b"") for i in range(self.size)]
        self.token_length = np.array([len(t) for t in flat], np.int64)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.token_flat = np.frombuffer(b"".join(flat), np.uint8)
        self.kind = np.full(0x110000, _UNKNOWN, np.uint8)
        self.pre = ByteLevel(add_prefix_space=False)  # what the file names; the model itself is not loaded

    def kinds(self, points: np.ndarray) -> np.ndarray:
        """Class of each code point."""
        kind = self.kind[points]
        if (kind == _UNKNOWN).any():
            for point in np.unique(points[kind == _UNKNOWN]).tolist():
                alone = lambda char: len(self.pre.pre_tokenize_str(char + chr(point))) == 1  # noqa: E731, B023
                self.kind[point] = _LETTER if alone("a") else _NUMBER if alone("1") else _OTHER if alone("!") else _SPACE
            kind = self.kind[points]
        return kind

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_code, code), len(self.pair_code) - 1)
        return np.where(self.pair_code[at] == code, self.pair_rank[at], _NO_RANK)

    @property
    def forced(self) -> np.ndarray:
        """forced[a, b]: bytes a and b stand side by side inside no token, so any a-b is a cut."""
        if not hasattr(self, "_forced"):
            table = np.ones((256, 256), bool)
            for i, token in self.token_bytes.items():
                flat = np.frombuffer(token, np.uint8)
                table[flat[:-1], flat[1:]] = False
            self._forced = table
        return self._forced


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def pre_tokens(vocab: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start bytes of the pre-tokens of a slice, the id of special ones (else -1), first pre-token of each text."""
    raw = data.tobytes()
    cuts, special_at = [offsets], {}
    for text, number in vocab.special.items():
        mark, at = text.encode(), -1
        while (at := raw.find(mark, at + 1)) >= 0:
            inner = np.searchsorted(offsets, at, side="right")
            if inner < len(offsets) and offsets[inner] < at + len(mark):  # joins two texts
                continue
            special_at[at] = number
            cuts.append(np.array([at, at + len(mark)]))
            at += len(mark) - 1
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    at_byte = np.flatnonzero((data & 0xC0) != 0x80)
    n = len(points)
    hard = np.zeros(n + 3, bool)
    hard[np.searchsorted(at_byte, np.unique(np.concatenate(cuts)))] = True
    hard[0] = hard[n:] = True
    kind = vocab.kinds(points)
    start = hard[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # The last white space before other text stands alone; a blank joins what follows.
    space = kind == _SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~hard[1:n])
    start[last] = True
    start[last[points[last] == 0x20] + 1] = False
    # Contractions begin a pre-token of their own and end it.
    padded = np.concatenate([points, np.zeros(3, np.uint32)])
    for i in np.flatnonzero((points == 0x27) & start).tolist():
        if hard[i + 1]:
            continue
        tail = "".join(map(chr, padded[i + 1 : i + 3]))
        size = 2 if tail[0] in _SHORT_ENDINGS else 3 if tail in _LONG_ENDINGS and not hard[i + 2] else 0
        if size:
            start[i + 1 : i + size] = False
            if i + size < n:
                start[i + size] = True
    begins = at_byte[start]
    special = np.full(len(begins), -1, np.int64)
    for at, number in special_at.items():
        lo, hi = np.searchsorted(begins, [at, at + len(vocab.token_bytes[number])])
        special[lo] = number
        special[lo + 1 : hi] = -2  # inside a special token: dropped below
    stay = special != -2
    begins, special = begins[stay], special[stay]
    return begins, special, np.searchsorted(begins, offsets)


def merge(vocab: Vocabulary, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of byte sequences laid end to end, and how many each has.

    Every round applies to each sequence all occurrences of its lowest-ranked pair, left to
    right. Sequences up to ``LONG_SEQUENCE`` bytes are merged together as ragged arrays, longer
    ones by themselves with linked places.
    """
    long = np.flatnonzero(lengths > LONG_SEQUENCE)
    if not len(long):
        return _merge_ragged(vocab, flat, lengths)
    first = np.cumsum(lengths) - lengths
    short = np.flatnonzero(lengths <= LONG_SEQUENCE)
    ids, counts = _merge_ragged(vocab, arrays.ragged_take(flat, first[short], lengths[short]), lengths[short])
    parts = dict(zip(long.tolist(), (_merge_linked(vocab, flat[first[i] : first[i] + lengths[i]]) for i in long.tolist())))
    out_counts = np.zeros(len(lengths), np.int64)
    out_counts[short] = counts
    out_counts[long] = [len(parts[i]) for i in long.tolist()]
    out = np.zeros(int(out_counts.sum()), np.int64)
    at = np.cumsum(out_counts) - out_counts
    out[np.repeat(at[short] - (np.cumsum(counts) - counts), counts) + np.arange(len(ids))] = ids
    for i, part in parts.items():
        out[at[i] : at[i] + len(part)] = part
    return out, out_counts


def _every_second(at: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Of runs of places each of which follows the one before, the first, third and so on."""
    run = np.maximum.accumulate(np.where(~follows, np.arange(len(at)), 0))
    return at[(np.arange(len(at)) - run) % 2 == 0]


def _merge_linked(vocab: Vocabulary, flat: np.ndarray) -> np.ndarray:
    """Ids of one sequence. A round costs the places of its rank, not the length of the sequence.

    Places are kept by the rank of the pair that begins there, and neighbours are linked. A
    place that has changed since is found by ranking its pair again.
    """
    n = len(flat)
    ids = np.append(vocab.byte_id[flat], -1)
    after, before = np.arange(1, n + 2), np.arange(-1, n)  # the end mark is place n
    alive = np.ones(n + 1, bool)
    alive[n] = False
    waiting: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def ranked(at: np.ndarray) -> np.ndarray:
        right = after[at]
        return np.where(alive[at] & (right < n), vocab.ranks(ids[at], np.maximum(ids[np.minimum(right, n)], 0)), _NO_RANK)

    def wait(at: np.ndarray) -> None:
        rank = ranked(at)
        at, rank = at[rank != _NO_RANK], rank[rank != _NO_RANK]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        begins = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]])) if len(rank) else []
        for lo, hi in zip(begins, [*begins[1:], len(rank)]):
            key = int(rank[lo])
            if key not in waiting:
                waiting[key] = []
                heapq.heappush(queue, key)
            waiting[key].append(at[lo:hi])

    wait(np.arange(n))
    while queue:
        rank = heapq.heappop(queue)
        at = np.unique(np.concatenate(waiting.pop(rank)))
        at = at[ranked(at) == rank]
        if not len(at):
            continue
        at = _every_second(at, np.concatenate([[False], at[1:] == after[at[:-1]]]))
        right = after[at]
        ids[at] = vocab.merged[rank]
        alive[right] = False
        after[at] = after[right]
        inner = after[at] < n
        before[after[at][inner]] = at[inner]
        left = before[at]
        wait(np.unique(np.concatenate([at, left[left >= 0]])))
    return ids[:n][alive[:n]]


def _merge_ragged(vocab: Vocabulary, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequences without a ranked pair leave the arrays."""
    ids = vocab.byte_id[flat]
    owner = np.repeat(np.arange(len(lengths)), lengths)
    counts = np.zeros(len(lengths), np.int64)
    done_ids, done_owner = [], []
    while len(ids):
        rank = np.full(len(ids), _NO_RANK, np.int64)
        rank[:-1] = np.where(owner[1:] == owner[:-1], vocab.ranks(ids[:-1], ids[1:]), _NO_RANK)
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        size = np.diff(np.append(first, len(ids)))
        least = np.minimum.reduceat(rank, first)
        over = np.repeat(least == _NO_RANK, size)
        done_ids.append(ids[over])
        done_owner.append(owner[over])
        counts[owner[first[least == _NO_RANK]]] = size[least == _NO_RANK]
        hit = ~over & (rank == np.repeat(least, size))
        # In a run of overlapping occurrences every second one counts.
        at = np.flatnonzero(hit)
        at = _every_second(at, np.concatenate([[False], at[1:] == at[:-1] + 1])) if len(at) else at
        ids[at] = vocab.merged[rank[at]]
        stay = ~over
        stay[at + 1] = False
        ids, owner = ids[stay], owner[stay]
    if done_ids:
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        ids = ids[np.argsort(owner, kind="stable")]
    return ids, counts


def distinct_ranges(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Each distinct byte range, one place where it stands, and the number of it for each range.

    Ranges are brought together by a hash, and then compared byte by byte; should the hash join
    different ones, a dictionary tells them apart.
    """
    raw = data.tobytes()
    _, where, number = np.unique(arrays.range_hashes(data, begins, ends), return_index=True, return_inverse=True)
    length, same = ends - begins, where[number]
    equal = (length == length[same]).all()
    if not equal or (arrays.ragged_take(data, begins, length) != arrays.ragged_take(data, begins[same], length)).any():
        numbers: dict[bytes, int] = {}
        number = np.fromiter((numbers.setdefault(raw[a:b], len(numbers)) for a, b in zip(begins.tolist(), ends.tolist())), np.int64, len(begins))
        where = np.zeros(len(numbers), np.int64)
        where[number[::-1]] = np.arange(len(number))[::-1]
    return [raw[a:b] for a, b in zip(begins[where].tolist(), ends[where].tolist())], where, number
