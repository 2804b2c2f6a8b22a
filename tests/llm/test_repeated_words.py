"""Substring dedup of texts that repeat themselves, and of words whose fast hashes are equal."""

import random

import xxhash
from test_pairs import repeats
from treelens.llm import substrings


def test_periodic_texts_equal_brute_force(spark, make):
    rng = random.Random(3)
    base = [["ha"] * 160, ["a", "b"] * 80, ["p", "q", "r"] * 54, [f"w{rng.randint(0, 9)}" for _ in range(160)]]
    texts = []
    for _ in range(150):
        parts = [rng.choice(base)[(s := rng.randint(0, 100)) : s + rng.choice([20, 49, 50, 51, 60])] for _ in range(rng.randint(1, 3))]
        texts.append(" ".join(w for p in parts for w in p))
    rows = list(enumerate(texts))
    rng.shuffle(rows)  # the places of a text among others differ from scan to scan
    docs = make([t for _, t in rows], [i for i, _ in rows]).repartition(3)
    got = substrings.remove_repeats(docs).collect()
    assert sorted(((r.doc_id, r.kept_text, r.n_words, r.n_removed) for r in got), key=str) == repeats(rows, 50)


def test_words_of_equal_xxh3(spark, make):
    """XXH3 multiplies the two halves of 16 bytes, each mixed with a constant, so halves can change places."""
    mask = bytes.fromhex("c4ffed15d485e6a2")
    other = lambda half: bytes(a ^ b for a, b in zip(half, mask))
    x, y, tail = b'%A`a%0`"', b"&Bab&1a#", b"abcdefghijklmnop"
    one, two = x + y + tail, other(y) + other(x) + tail
    assert xxhash.xxh3_64_intdigest(one) == xxhash.xxh3_64_intdigest(two)
    one, two, rest = one.decode(), two.decode(), " ".join(f"w{i}" for i in range(70))
    texts = [f"{one} {rest}", f"{two} {rest}", f"{one} {rest}", f"q {two} {rest} q"]
    got = substrings.remove_repeats(make(texts)).orderBy("doc_id").collect()
    assert [(r.doc_id, r.kept_text, r.n_words, r.n_removed) for r in got] == repeats(list(enumerate(texts)), 50)
