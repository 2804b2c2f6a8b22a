"""Packing: tokens against the library, every token in one piece, no padding, balance."""

import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from treelens.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
SF_DIR = os.environ.get("TREELENS_SF_DIR", "/root/testdata/sf0.001")


def library_ids(texts):
    t = Tokenizer.from_file(PATH)
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def odd_texts():
    rng = random.Random(3)
    alphabet = "aAbéÉß İΣσς'’s''ve(\".,!? \t\n\r\x0b\x0c\x1c\x1f\x85  ̸́中文字1²Ⅷ😀\x00"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += ["<|endoftext|>", "a<|endoftext|>b <|startoftext|> c", "x <|endof text|>", "<|endoftext|", "text|> <", "it's we'VE I'm", "é ́e"]
    return texts + [None, "", " ", "word " * 9000, "y" * 30_000, "Ünï " * 200_000]


def test_words_give_the_ids_of_the_library():
    import pyarrow as pa

    texts = odd_texts()
    encoder = packing.WordEncoder(PATH)
    for _ in range(2):  # with an empty memory and with a full one
        assert [ids.tolist() for ids in encoder.texts(pa.array(texts))] == library_ids(texts)
    assert not any(len(word) > packing._LONG_WORD for word in (*encoder.known, *encoder.older))


def test_words_are_counted_as_the_library_splits_them():
    import pyarrow as pa

    rng = random.Random(11)
    alphabet = "abcdeéèßñçüœšžÀÑøæþµªº²¼×÷«»¿§°0123456789.,;:!?'\"()-_/&%$#@[]{}~|<>=+*^`"
    texts = [" ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 12))) for _ in range(50)) for _ in range(200)]
    encoder = packing.WordEncoder(PATH)
    assert encoder.counted and packing._COUNTED.fullmatch(" ".join(texts).lower())
    assert [ids.tolist() for ids in encoder.texts(pa.array(texts))] == library_ids(texts)


def test_small_memory_gives_the_same_ids(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(packing, "_MEMORY", 5)
    texts = odd_texts()[:100]
    encoder = packing.WordEncoder(PATH)
    for text, ids in zip(texts, library_ids(texts)):
        assert encoder.texts(pa.array([text]))[0].tolist() == ids


def test_assign_fills_every_room():
    rng = random.Random(1)
    for _ in range(60):
        lengths = [rng.choice([1, 3, 50, rng.randint(1, 99)]) for _ in range(rng.randint(0, 80))]
        total = sum(lengths)
        rooms = [100] * (total // 100) + packing._powers(total % 100)
        pieces = packing.assign(lengths, rooms)
        held = [[] for _ in lengths]
        filled = [[] for _ in rooms]
        for document, start, size, sequence, offset in pieces:
            held[document].append((start, size))
            filled[sequence].append((offset, size))
        for n, parts in [*zip(lengths, held), *zip(rooms, filled)]:
            at = 0
            for start, size in sorted(parts):
                assert start == at and size > 0
                at += size
            assert at == n


def test_assign_takes_the_cheapest_sequence_with_room():
    # The long ones go apart, the short ones to the cheaper of the two.
    assert packing.assign([60, 50, 30, 20], [100, 100], 0.0, 1.0) == [(0, 0, 60, 0, 0), (1, 0, 50, 1, 0), (2, 0, 30, 1, 50), (3, 0, 20, 1, 80)]
    # No sequence has room for the last: it fills the cheapest and goes on in the other.
    assert packing.assign([70, 60, 50], [90, 90], 0.0, 1.0)[2:] == [(2, 0, 30, 1, 60), (2, 30, 20, 0, 70)]


def test_costs_are_balanced():
    rng = np.random.default_rng(0)
    lengths = np.minimum(rng.lognormal(6, 1.2, 3000).astype(int) + 1, 4095).tolist()
    rooms = [4096] * (sum(lengths) // 4096)

    def spread(linear, quadratic):
        cost = np.zeros(len(rooms))
        for _, _, size, sequence, _ in packing.assign(lengths, rooms, linear, quadratic):
            cost[sequence] += packing.LINEAR * size + packing.QUADRATIC * size**2
        return np.std(cost) / np.mean(cost)

    # Without costs the first sequence with room takes a document.
    assert spread(packing.LINEAR, packing.QUADRATIC) < 0.95 * spread(0.0, 0.0)


def check(rows, texts, length):
    """rows: (doc place, start, length, ids, doc_tokens, sequence_id, offset)."""
    pieces, sequences = {}, {}
    for doc, start, n, ids, tokens, sequence, offset in rows:
        assert len(ids) == 4 * n
        pieces.setdefault(doc, []).append((start, n, bytes(ids), tokens))
        sequences.setdefault(sequence, []).append((offset, n))
    for doc, ids in enumerate(library_ids(texts)):
        want = np.array([*ids, packing.END], "<u4").tobytes()
        assert b"".join(p[2] for p in sorted(pieces[doc])) == want
        assert all(start * 4 == len(b"".join(p[2] for p in sorted(pieces[doc])[:i])) for i, (start, *_) in enumerate(sorted(pieces[doc])))
        assert {p[3] for p in pieces[doc]} == {len(ids) + 1}
    assert len(pieces) == len(texts)
    sizes = []
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == length or (at < length and at & (at - 1) == 0)
        sizes.append(at)
    return sizes


@pytest.mark.parametrize("block", [64, 1 << 21])
def test_pack_whole_texts(spark, make, block):
    texts = odd_texts() + [f"copy {i % 3}" for i in range(500)]
    docs = make(texts).withColumn("start", F.lit("x")).withColumn("ids", F.lit(1)).repartition(5)
    rows = [tuple(r) for r in packing.pack(docs, PATH, length=64, block_tokens=block).collect()]
    sizes = check(rows, texts, 64)
    assert sum(s < 64 for s in sizes) <= 5 * 6


def test_pack_edges(spark, make):
    assert packing.pack(make([]), PATH).count() == 0
    rows = packing.pack(make([None, "", None], ids=[5, 5, None]), PATH).collect()
    assert sorted((r.doc_id is None, r.length, r.doc_tokens) for r in rows) == [(False, 1, 1), (False, 1, 1), (True, 1, 1)]
    with pytest.raises(ValueError):
        packing.pack(make([]).withColumn("offset", F.lit(1)), PATH, keep=["offset"])
    with pytest.raises(ValueError):
        packing.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = packing.op13_sequence_packing(spark, SF_DIR).collect()
    ids = dict(zip((r.doc_id for r in docs), library_ids([r.text for r in docs])))
    sequences, seen = {}, {}
    for r in rows:
        tokens = [*ids[r.doc_id], 2]
        assert r.doc_tokens == len(tokens)
        assert r.ids_crc32 == zlib.crc32(np.array(tokens[r.start : r.start + r.length], "<u4").tobytes())
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        seen[r.doc_id] = seen.get(r.doc_id, 0) + r.length
    assert seen == {d: len(i) + 1 for d, i in ids.items()}
    sizes = [sum(n for _, n in parts) for parts in sequences.values()]
    assert all(s == 4096 or (s < 4096 and s & (s - 1) == 0) for s in sizes)
