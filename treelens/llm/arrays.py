"""Texts of an Arrow batch as flat numpy arrays.

A batch of texts is one byte array and the offsets of its texts. Words are index
ranges of that array, so splitting, hashing and windowing need no Python object per
word. All work is done in slices of whole texts; a slice holds about
``SLICE_BYTES``, or one text if that is longer.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 1 << 20
_RELEASE_BYTES = 4 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0D]")

_MULTIPLIER = 0x9E3779B97F4A7C15 | 2  # odd and 3 modulo 4
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _byte_table(separator) -> np.ndarray:
    return np.array([separator(b) for b in range(256)], dtype=bool)


#: ASCII white space: space and 0x09 to 0x0D.
WHITE_SPACE = _byte_table(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)
#: Every ASCII byte that is neither digit nor lower-case letter (texts are lower-cased before).
NOT_ALPHANUMERIC = _byte_table(lambda b: b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F)
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def lower(data: np.ndarray) -> np.ndarray:
    """ASCII capitals to small letters, all other bytes unchanged."""
    return _LOWER[data]


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of an Arrow column and the offsets of each; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[at[0] : at[-1]], at - at[0]


def release() -> None:
    """Give memory that is free in this worker back to the system; the executor's other worker and its JVM share the limit.

    Arrow's pool and the C library keep it otherwise, for as long as the worker lives.
    """
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):  # glibc only
        _LIBC.malloc_trim(0)


_LIBC = ctypes.CDLL(None)


def slices(data: np.ndarray, offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole texts: number of the first text, its bytes, its offsets.

    What work on them took is released every ``_RELEASE_BYTES`` and after the last.
    """
    first, n, kept = 0, len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        kept += int(offsets[last] - offsets[first])
        first = last
        if kept >= _RELEASE_BYTES or first == n:
            release()
            kept = 0


def pieces(raw: bytes, size: int = SLICE_BYTES) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes, cut before ASCII white space (or not at all, if it has none)."""
    at = 0
    while at < len(raw):
        cut = _BLANK.search(raw, at + size)
        end = cut.start() if cut else len(raw)
        yield raw[at:end]
        at = end


def word_bounds(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the word numbers at which texts begin (one more than texts)."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = ~separators[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers = {_MULTIPLIER: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def _power_table(base: int, n: int) -> np.ndarray:
    table = _powers[base]
    while len(table) < n:
        step = np.uint64(pow(base, len(table), 1 << 64))
        table = np.concatenate([table, table * step])
    if len(table) <= 4 * SLICE_BYTES:  # those of an extremely long text are not kept
        _powers[base] = table
    return table[:n]


def _range_sums(values: np.ndarray):
    """A function giving a 64-bit hash of values[lo:hi] for arrays of bounds."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power_table(_MULTIPLIER, len(values)), out=sums[1:])
    back = _power_table(_INVERSE, len(values) + 1)

    def hashes(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        length = (hi - lo).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return mix(((sums[hi] - sums[lo]) * back[lo]) ^ length)

    return hashes


def range_hasher(data: np.ndarray):
    """A function giving a 64-bit hash of each byte range; equal bytes have equal hashes in every batch.

    For features only: sequences can be built whose hashes are equal.
    """
    return _range_sums(_BYTE_VALUES[data])


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ``range_hasher``, for features only."""
    return range_hasher(data)(starts, ends)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XXH3 of each byte range."""
    raw, digest = data.tobytes(), xxhash.xxh3_64_intdigest
    return np.fromiter((digest(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))


_PRIME = np.uint64((1 << 61) - 1)
_LOW32, _LOW29, _32, _29, _61 = (np.uint64(x) for x in ((1 << 32) - 1, (1 << 29) - 1, 32, 29, 61))
_BASES = (0x0B2F8C6D51E39A47, 0x15D3A90F7E64C82B)  # below the prime, of no pattern


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _PRIME) + (x >> _61)
    return np.where(x >= _PRIME, x - _PRIME, x)


def _times_2_32(x: np.ndarray) -> np.ndarray:
    """x * 2**32 modulo the prime, not yet reduced; x below 2**61."""
    return (x >> _29) + ((x & _LOW29) << _32)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, for values below it."""
    a_high, a_low, b_high, b_low = a >> _32, a & _LOW32, b >> _32, b & _LOW32
    low = a_low * b_low
    middle = _reduced(a_high * b_low + a_low * b_high)
    return _reduced(_reduced((a_high * b_high << np.uint64(3)) + _times_2_32(middle)) + (low & _PRIME) + (low >> _61))


_prime_powers = {base: np.ones(1, np.uint64) for b in _BASES for base in (b, pow(b, -1, int(_PRIME)))}


def _prime_power_table(base: int, n: int) -> np.ndarray:
    table = _prime_powers[base]
    while len(table) < n:
        step = np.uint64(pow(base, len(table), int(_PRIME)))
        table = np.concatenate([table, _product(table, np.broadcast_to(step, table.shape))])
    if len(table) <= 4 * SLICE_BYTES:
        _prime_powers[base] = table
    return table[:n]


def sequence_hasher(values: np.ndarray, base: int = 0):
    """A function giving a 64-bit hash of values[lo:hi]: their polynomial modulo 2**61 - 1 at one of two bases.

    Modulo a prime there are no patterns that collide whatever their values are, as there
    are modulo a power of two. The two bases give independent hashes.
    """
    at = _BASES[base]
    terms = _product(_reduced(values), _prime_power_table(at, len(values)))
    low, high = np.zeros(len(values) + 1, np.uint64), np.zeros(len(values) + 1, np.uint64)
    np.cumsum(terms & _LOW32, out=low[1:])
    np.cumsum(terms >> _32, out=high[1:])
    sums = _reduced(_times_2_32(_reduced(high)) + _reduced(low))
    back = _prime_power_table(pow(at, -1, int(_PRIME)), len(values) + 1)

    def hashes(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        between = _product(_reduced(sums[hi] + _PRIME - sums[lo]), back[lo])
        return mix(between ^ ((hi - lo).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))

    return hashes


class Grams:
    """Hashes of word sequences within a slice."""

    def __init__(self, word_hash: np.ndarray, first_words: np.ndarray):
        self.words = len(word_hash)
        self.begin = np.repeat(first_words[:-1], np.diff(first_words))  # of the text of each word
        self.end = np.repeat(first_words[1:], np.diff(first_words))
        self.word_hash = word_hash
        self.hash_range = sequence_hasher(word_hash)

    def starts(self, n: int) -> np.ndarray:
        """Words at which n words of one text begin."""
        at = np.arange(self.words)
        return at[at + n <= self.end]

    def hashes(self, at: np.ndarray, n: int) -> np.ndarray:
        return self.hash_range(at, at + n)

    @property
    def second(self):
        """A hash of word ranges independent of ``hash_range``."""
        if not hasattr(self, "_second"):
            self._second = sequence_hasher(self.word_hash, 1)
        return self._second


def winnow(grams: Grams, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The k-gram that each window of ``window`` words selects: its smallest hash.

    Returns the window starts and the word at which the selected k-gram begins.
    Equal windows select k-grams of equal hash, which is the winnowing guarantee. Which of
    several equal ones depends on their places in the text, never on the texts around it.
    """
    at = grams.starts(window)
    span = window - k + 1
    if not len(at):
        return at, at
    if span > 64:
        raise ValueError("a window may hold at most 64 k-grams")
    n = grams.words - k + 1
    every = np.arange(n)
    packed = grams.hashes(every, k) & ~np.uint64(63) | (np.uint64(63) - ((every - grams.begin[:n]) % 64).astype(np.uint64))
    padded = np.full(-(-n // span) * span, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = packed
    rows = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[at], ahead[at + span - 1])
    slot = 63 - (least & np.uint64(63)).astype(np.int64)
    return at, at + (slot - (at - grams.begin[at])) % 64


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def ragged_take(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ranges flat[start:start+length], one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]
