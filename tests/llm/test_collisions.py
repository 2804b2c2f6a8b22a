"""Sequences on which polynomial hashes modulo a power of two collide, and runs without blanks."""

import random
import time

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer
from treelens.llm import arrays, bpe, bpe_codec, decontamination, substrings, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def pair(length, a="a", b="b"):
    """A Thue-Morse sequence and the same with its two letters exchanged."""
    odd = [bin(i).count("1") & 1 for i in range(length)]
    return "".join(b if o else a for o in odd), "".join(a if o else b for o in odd)


def library(texts):
    t = Tokenizer.from_file(PATH)
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("length", [1024, 4096, 65536])
def test_tokens_of_colliding_words(length):
    s, c = pair(length)
    want = library([s, c])
    count = token_counts._count(PATH)
    assert count(pa.array([s, c])).field(1).to_pylist() == [len(w) for w in want]
    assert [count(pa.array([x])).field(1)[0].as_py() for x in (s, c)] == [len(w) for w in want]  # one batch after the other
    assert bpe_codec._encoder(PATH)(pa.array([s, c])).to_pylist() == want
    assert [bpe_codec._encoder(PATH)(pa.array([x]))[0].as_py() for x in (s, c)] == want


def test_hashes_of_colliding_sequences():
    for length in (1024, 65536):
        data = np.frombuffer("".join(pair(length)).encode(), np.uint8)
        ends = np.array([0, length, 2 * length])
        assert len(set(arrays.word_hashes(data, ends[:-1], ends[1:]).tolist())) == 2
        for base in (0, 1):
            hashes = arrays.sequence_hasher(data.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), base)
            assert len(set(hashes(ends[:-1], ends[1:]).tolist())) == 2


def test_sequence_hashes_are_polynomials_modulo_the_prime():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 2**64, 400, dtype=np.uint64)
    values[:4] = [0, 2**61 - 1, 2**61, 2**64 - 1]
    p = 2**61 - 1
    for base in (0, 1):
        hashes, b = arrays.sequence_hasher(values, base), arrays._BASES[base]
        lo = rng.integers(0, 400, 200)
        hi = np.minimum(lo + rng.integers(0, 80, 200), 400)
        plain = [sum(int(v) * pow(b, i, p) for i, v in enumerate(values[a:z])) % p for a, z in zip(lo.tolist(), hi.tolist())]
        want = arrays.mix(np.array(plain, np.uint64) ^ ((hi - lo).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        assert (hashes(lo, hi) == want).all()


def test_substrings_of_colliding_words(spark, make):
    for length in (1024, 4096):
        s, c = pair(length)
        rest = " ".join(f"w{i}" for i in range(49))
        got = substrings.remove_repeats(make([f"{s} {rest}", f"{c} {rest}", f"{s} {rest}"])).orderBy("doc_id").collect()
        assert [r.n_removed for r in got] == [0, 0, 50]


def test_benchmark_of_colliding_words(spark, make):
    s, c = pair(4096)
    rest = " ".join(f"w{i}" for i in range(9))
    items = spark.createDataFrame([(1, f"{s} {rest}")], "item_id long, text string")
    got = decontamination.contamination(make([f"{c} {rest}", f"x {s} {rest} y", None]), items).orderBy("doc_id").collect()
    assert [(r.n_hit, r["items"]) for r in got] == [(0, []), (10, ["1"]), (0, [])]


def test_many_hits_in_one_text(spark, make):
    item = " ".join(f"w{i}" for i in range(10))
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    text = " x ".join([item] * 20_000)
    begin = time.time()
    row = decontamination.contamination(make([text]), items).first()
    assert (row.n_hit, len(row.hits), row.n_words) == (200_000, 20_000, 219_999)
    assert [tuple(h) for h in row.hits[:2]] == [(0, 10), (11, 21)]
    assert time.time() - begin < 60


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghijklmnopqrstuvwxyz", "ABab01+/", "中文字漢", "aaaaaaab"])
def test_long_runs_equal_the_library(alphabet):
    rng = random.Random(len(alphabet))
    for length in (bpe.LONG_SEQUENCE, bpe.LONG_SEQUENCE + 1, 3000, 20_000):
        texts = ["".join(rng.choice(alphabet) for _ in range(length)), "x", "a" * length, ""]
        assert bpe_codec._encoder(PATH)(pa.array(texts)).to_pylist() == library(texts)


def test_long_runs_take_seconds():
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1 << 20))
    begin = time.time()
    got = token_counts._count(PATH)(pa.array([text])).field(1)[0].as_py()
    took = time.time() - begin
    assert got == len(library([text])[0])
    assert took < 30


def test_remembered_fragments_take_little_and_their_bytes_decide(monkeypatch):
    import gc
    import tracemalloc

    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(40000)]
    texts = pa.array([" ".join(words[i : i + 500]) for i in range(0, len(words), 500)] * 2)
    library = Tokenizer.from_file(path)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts.to_pylist()]
    monkeypatch.setattr(bpe_codec, "_memory", {})
    tracemalloc.start()
    right = bpe_codec._encoder(path)(texts).to_pylist() == want
    memory = bpe_codec._memory.pop(path)
    known = len(memory.late.length) + len(memory.before.length)
    gc.collect()
    before = tracemalloc.get_traced_memory()[0]
    del memory
    gc.collect()
    taken = before - tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert right and known > 30000 and taken < 100 * known
    # Every fragment has one of three hashes.
    monkeypatch.setattr(bpe_codec, "_memory", {})
    monkeypatch.setattr(arrays, "range_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64) % np.uint64(3))
    some = texts.slice(0, 3)
    for _ in range(2):
        assert bpe_codec._encoder(path)(some).to_pylist() == want[:3]
