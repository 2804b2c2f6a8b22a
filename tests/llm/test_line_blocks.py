"""Lines joined on SimHash blocks: signatures, links and recall against plain Python and the complete search."""

import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_pairs import distance, roots
from treelens.llm import arrays, line_blocks as B, lines

SF_DIR = os.environ.get("TREELENS_SF_DIR", "/root/testdata/sf0.001")


def word_hash(word, known={}):  # noqa: B006
    if word not in known:
        known[word] = int(arrays.range_hashes(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0])
    return known[word]


def simhash(words):
    return sum(1 << b for b in range(64) if 2 * sum(word_hash(w) >> b & 1 for w in words) > len(words))


def pieces(words, radius):
    h = [word_hash(w) for w in words]
    cuts = [0]
    for i in range(1, len(h)):
        if i >= radius and len(h) - i > radius and h[i] < min(h[i - radius : i]) and h[i] <= min(h[i + 1 : i + radius + 1]):
            cuts.append(i)
    return [words[a:b] for a, b in zip(cuts, [*cuts[1:], len(h)])]


def plain_blocks(words):
    """Blocks as (kind, SimHash); kinds are the scales and short lines by length."""
    n, out = len(words), []
    for number, (least, most, radius) in enumerate(B.SCALES):
        if least <= n <= (most or n):
            out += [(number, simhash(p)) for p in pieces(words, radius) if len(p) > radius]
    if 4 <= n <= 9:
        out.append((f"short {n}", simhash(words)))
    if 5 <= n <= 9:
        out += [(f"short {n - 1}", simhash(words[:i] + words[i + 1 :])) for i in range(n)]
    return out


def word(rng, length=3):
    return "".join(rng.choice("bcdfghjklmnpqrstvwxyz") for _ in range(length))  # digits would all become 0


def some_lines(rng, count):
    words = [word(rng, 2) for _ in range(300)] + ["the"] * 40 + ["of"] * 30
    out = []
    for _ in range(count):
        n = rng.choice([1, 3, 4, 5, 6, 8, 9, 10, 12, 15, 20, 24, 27, 30, 45, 64, 79, 80, 90, 150])
        own = [rng.choice(words) for _ in range(n)]
        out.append(own)
        for _ in range(rng.randint(0, 2)):
            other = list(own)
            for _ in range(rng.randint(1, max(1, n // 5))):
                at = rng.randrange(len(other)) if other else 0
                other[at : at + 1] = rng.choice([["zz"], [], [*other[at : at + 1], "yy"]])
            out.append(other)
    return [w for w in out if w]


def test_signatures_equal_plain_ones(monkeypatch):
    some = some_lines(random.Random(1), 150) + [["a"] * 30, ["a", "b"] * 12, ["a"] * 700]
    for chunk, lane in ((B._CHUNK, B._LANE), (21, 7)):
        monkeypatch.setattr(B, "_CHUNK", chunk)
        monkeypatch.setattr(B, "_LANE", lane)
        n, sim, blocks, bounds = B.line_signatures([" ".join(w).encode() for w in some])
        assert n.tolist() == [len(w) for w in some]
        assert sim.tolist() == [simhash([x.encode() for x in w]) for w in some]
        for i, w in enumerate(some):
            assert bounds[i + 1] - bounds[i] == len(plain_blocks([x.encode() for x in w]))
        # Equal numbers mean equal blocks, everywhere.
        pairs = {}
        for i, w in enumerate(some):
            for g, p in zip(blocks[bounds[i] : bounds[i + 1]].tolist(), plain_blocks([x.encode() for x in w])):
                assert pairs.setdefault(g, p) == p
        assert len(set(pairs.values())) == len(pairs)


def model(texts, similarity=0.8, max_bits=B.MAX_BITS, complete=False):
    """Line numbers that go, by text."""
    spots = [(d, n, p) for d, t in enumerate(texts) if t is not None for n, x in enumerate(t.split("\n")) if (p := lines.normalise(x.encode()))]
    plain = sorted({p for *_, p in spots})
    split = [p.split() for p in plain]
    filed = defaultdict(set)
    for i, w in enumerate(split):
        for block in plain_blocks(w):
            filed[block].add(i)
    pairs = {(a, b) for group in filed.values() for a in group for b in group if a < b}
    if complete:
        pairs = {(a, b) for b in range(len(plain)) for a in range(b)}
    sims = [simhash(w) for w in split]
    links = []
    for a, b in pairs:
        longer = max(len(split[a]), len(split[b]))
        if abs(len(split[a]) - len(split[b])) > int(longer * (1 - similarity) + 1e-9):
            continue
        if not complete and longer > 9 and bin(sims[a] ^ sims[b]).count("1") > max_bits:
            continue
        if distance(split[a], split[b]) <= int(longer * (1 - similarity) + 1e-9):
            links.append((a, b))
    group, seen, gone = dict(zip(plain, roots(len(plain), links))), set(), defaultdict(set)
    for d, n, p in spots:
        if group[p] in seen:
            gone[d].add(n)
        seen.add(group[p])
    return gone


def got(df):
    return {r.doc_id: (r.text, r.n_removed) for r in df.collect()}


def want(texts, gone):
    out = {}
    for i, t in enumerate(texts):
        out[i] = (t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i]), len(gone[i]))
    return out


def test_removal_equals_plain_model(spark, make):
    rng = random.Random(5)
    some = [" ".join(w) for w in some_lines(rng, 160)]
    rng.shuffle(some)
    texts = ["\n".join(some[i : i + 3]) for i in range(0, len(some), 3)]
    texts += [None, "", "\n\n", " ?! \n...", "THE same Line,\nthe same line", "x\r\ny\r\nx", "the long " * 4000, "the long " * 4000 + "end"]
    texts += [some[0]] * 40 + [some[1] + "\n" + some[2]] * 3
    docs = make(texts).withColumn("n_removed", F.lit("x")).withColumn("block", F.lit(0)).repartition(5)
    assert got(B.dedupe_similar_lines(docs)) == want(texts, model(texts))


def test_short_lines_are_complete(spark, make):
    rng = random.Random(6)
    words = [word(rng) for _ in range(60)]
    texts = []
    for _ in range(120):
        own = [rng.choice(words) for _ in range(rng.randint(1, 9))]
        other = list(own)
        at = rng.randrange(len(other))
        other[at : at + 1] = rng.choice([["zz"], [], [other[at], "yy"]])
        texts += [" ".join(own), " ".join(other[:9])]
    gone = model(texts, complete=True)
    assert sum(map(len, gone.values())) > 60
    assert got(B.dedupe_similar_lines(make(texts))) == want(texts, gone)


def test_crowded_blocks_keep_near_copies_together(spark, make):
    rng = random.Random(7)
    base = [word(rng) for _ in range(40)]
    texts = []
    for i in range(60):
        own = list(base)
        own[rng.randrange(40)] = word(rng, 6)
        texts.append(" ".join(own))
    # Lines that share a passage and nothing else stay, however many they are.
    texts += [" ".join([*base[:12], *(word(rng, 5) for _ in range(40))]) for _ in range(60)]
    for hot in (5, 1024):
        left = got(B.dedupe_similar_lines(make(texts), hot=hot))
        assert [i for i, (t, n) in sorted(left.items()) if n == 0] == [0, *range(60, 120)]


def test_no_rows_and_no_lines(spark, make):
    assert B.dedupe_similar_lines(make([])).count() == 0
    assert got(B.dedupe_similar_lines(make([None, "", "."]))) == {0: (None, 0), 1: ("", 0), 2: (".", 0)}
    ids = [None, None, 4, 4]
    rows = B.dedupe_similar_lines(make(["a b", "a b", "a b", "a b\nc"], ids)).collect()
    assert sorted((str(r.doc_id), r.text) for r in rows) == [("4", "a b"), ("4", "a b\nc"), ("None", "a b"), ("None", "a b")]
    with pytest.raises(ValueError):
        B.dedupe_similar_lines(make([]), similarity=0)


def test_share_of_the_links_of_the_complete_search():
    """Pairs of different lines of at least 0.8, found by all pairs that share a rare word; by words of the longer line."""
    import duckdb

    texts = [t for (t,) in duckdb.sql(f"SELECT text FROM '{SF_DIR}/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    plain = sorted({p for t in texts for x in t.encode().split(b"\n") if (p := lines.normalise(x))})
    rng = random.Random(8)
    split = [p.split() for p in plain]
    # Copies with edits at random places up to the limit, beside those that the texts hold.
    for words in rng.sample([w for w in split if len(w) >= 5], 400):
        other = list(words)
        for _ in range(rng.randint(1, max(1, len(words) // 8))):
            at = rng.randrange(len(other))
            other[at : at + 1] = rng.choice([[b"zz"], [], [other[at], b"yy"]])
        split.append(other)
    split = sorted({tuple(w) for w in split if w})
    common = Counter(w for line in split for w in set(line))
    filed = defaultdict(list)
    for i, line in enumerate(split):
        for w in sorted(set(line), key=lambda w: (common[w], w))[: len(line) // 5 + 2]:
            if common[w] > 1:
                filed[w].append(i)
    pairs = {(a, b) for group in filed.values() for a in group for b in group if a < b}
    found, links = Counter(), Counter()
    n, sim, blocks, bounds = B.line_signatures([b" ".join(w) for w in split])
    for a, b in pairs:
        longer = max(len(split[a]), len(split[b]))
        allowed = int(longer * 0.2 + 1e-9)
        if abs(len(split[a]) - len(split[b])) > allowed or distance(split[a], split[b]) > allowed:
            continue
        kind = next(k for k in (9, 19, 39, 10**9) if longer <= k)
        links[kind] += 1
        shared = set(blocks[bounds[a] : bounds[a + 1]].tolist()) & set(blocks[bounds[b] : bounds[b + 1]].tolist())
        found[kind] += bool(shared) and (longer <= 9 or bin(int(sim[a]) ^ int(sim[b])).count("1") <= B.MAX_BITS)
    share = {k: (found[k], links[k]) for k in sorted(links)}
    print(share)
    assert sum(links.values()) > 300 and all(f >= 0.9 * k for f, k in share.values())


def test_crowded_blocks_lose_no_link(spark, make):
    """Pairs of lines that share nothing but a crowded block; the result does not depend on what counts as crowded."""
    rng = random.Random(9)
    passage = [word(rng, 4) for _ in range(9)]
    texts = []
    for n in (16, 30, 70):
        for _ in range(12):
            own = [*(word(rng, 3) for _ in range(n // 2)), *passage[:n], *(word(rng, 3) for _ in range(n // 2))]
            other = list(own)
            for at in rng.sample([i for i, w in enumerate(own) if w not in passage], len(own) // 5 - 1):
                other[at] = word(rng, 5)
            texts += [" ".join(own), " ".join(other)]
    want_left = want(texts, model(texts))
    assert sum(n for _, n in want_left.values()) > 20
    for hot in (1, 4, 1024):
        assert got(B.dedupe_similar_lines(make(texts), hot=hot)) == want_left


def test_pipeline_stage_loses_no_link_of_crowded_blocks(spark, make, monkeypatch):
    import corpus_pipeline

    rng = random.Random(10)
    passage = [word(rng, 4) for _ in range(9)]
    texts = []
    for _ in range(8):
        own = [*(word(rng, 3) for _ in range(15)), *passage, *(word(rng, 3) for _ in range(15))]
        other = list(own)
        for at in rng.sample([i for i, w in enumerate(own) if w not in passage], 6):
            other[at] = word(rng, 5)
        texts += [" ".join(own), " ".join(other)]
    left = {i: t for i, (t, _) in want(texts, model(texts)).items()}
    assert "" in left.values()
    monkeypatch.setattr(B.dedupe_similar_lines, "__defaults__", (0.8, B.MAX_BITS, 1))
    docs = make(texts, extra="lang string, source string, n_chars long, a int, b int")
    assert {r.doc_id: r.text for r in corpus_pipeline.dedupe_lines(spark, docs, "").collect()} == left


def test_simhashes_far_apart_lose_no_link(spark, make):
    """Similar lines of a block whose SimHashes as a whole differ in many bits; alone, and as the pipeline's stage."""
    import corpus_pipeline

    rng = random.Random(12)
    texts, far = [], 0
    while far < 8:
        own = [word(rng, 4) for _ in range(12)]
        other = list(own)
        other[0], other[3] = word(rng, 5), word(rng, 5)
        split = [[x.encode() for x in w] for w in (own, other)]
        if (simhash(split[0]) ^ simhash(split[1])).bit_count() > 20 and set(plain_blocks(split[0])) & set(plain_blocks(split[1])):
            texts += [" ".join(own), " ".join(other)]
            far += 1
    left = [t if i % 2 == 0 else "" for i, t in enumerate(texts)]
    for hot in (1, 1024):
        assert [t for _, (t, _) in sorted(got(B.dedupe_similar_lines(make(texts), hot=hot)).items())] == left
    docs = make(texts, extra="lang string, source string, n_chars long, a int, b int")
    assert [r.text for r in corpus_pipeline.dedupe_lines(spark, docs, "").sort("doc_id").collect()] == left


def test_lines_of_crowded_blocks_grow_with_the_input(spark, make, monkeypatch):
    """A passage in 200 and in 1,000 otherwise different lines: as many times the lines meet on rare word pairs, and nothing goes."""
    rng = random.Random(13)
    passage = [word(rng, 4) for _ in range(40)]
    texts = [" ".join([*(word(rng, 5) for _ in range(15)), *passage, *(word(rng, 5) for _ in range(15))]) for _ in range(1200)]
    met, rare = [], B._rare
    monkeypatch.setattr(B, "_rare", lambda plain, similarity: met.append(plain.count()) or rare(plain, similarity))
    for part in (texts[:200], texts[200:]):
        assert {n for _, n in got(B.dedupe_similar_lines(make(part))).values()} == {0}
    assert met == [200, 1000]
