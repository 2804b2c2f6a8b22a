"""Substrings, lines, SimHash and embeddings against brute force on small inputs."""

import random
import re
from collections import defaultdict

import numpy as np
import xxhash
from treelens.llm import components, lines, simhash, substrings, vectors

SPLIT = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPLIT.split(text or "") if w]


def roots(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def repeats(rows, window):
    firsts = defaultdict(set)
    for i, text in rows:
        w = words(text)
        for p in range(len(w) - window + 1):
            if i is not None:
                firsts[tuple(w[p : p + window])].add(i)
    out = []
    for i, text in rows:
        w = words(text)
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and min(firsts[tuple(w[p : p + window])]) < i:
                gone.update(range(p, p + window))
        out.append((i, " ".join(x for p, x in enumerate(w) if p not in gone), len(w), len(gone)))
    return sorted(out, key=str)


def test_substrings_equal_brute_force(spark, make):
    rng = random.Random(4)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(60)) for _ in range(5)]
    texts = [None, "", " \t\n", "ha " * 80, "ha " * 90, "x" * 5000]
    for _ in range(60):
        parts = [rng.choice(base).split(" ") for _ in range(rng.randint(1, 3))]
        cut = [" ".join(p[rng.randint(0, 20) : rng.randint(30, 60)]) for p in parts]
        texts.append(rng.choice(["\n", "  ", " q "]).join(cut))
    ids = [*range(len(texts) - 4), 3, 3, None, None]  # repeated and missing ids
    rows = list(zip(ids, texts))
    got = substrings.remove_repeats(make(texts, ids), window=12, seed_words=4).collect()
    assert sorted(((r.doc_id, r.kept_text, r.n_words, r.n_removed) for r in got), key=str) == repeats(rows, 12)
    assert all(r.n_removed == sum(s.end - s.start for s in r.repeats) for r in got)
    assert all(s.end - s.start >= 12 for r in got for s in r.repeats)


def test_empty_tables(spark, make):
    none = make([]).limit(0)
    assert substrings.remove_repeats(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert lines.dedupe_lines(none).count() == 0
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def fingerprint(text):
    w = [x for x in SPLIT.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    n = min(4, len(w))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + n]).encode(), 42) for i in range(len(w) - n + 1)] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_equals_brute_force(spark, make):
    rng = random.Random(7)
    base = [" ".join(rng.choice(["Aa", "bé", "c", "dd", "E"]) + str(rng.randint(0, 50)) for _ in range(300)) for _ in range(6)]
    texts = [None, "", "  ", "one", "One", "a b c", "y" * 3000]
    for _ in range(80):
        w = rng.choice(base).split(" ")
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = "z"
        texts.append(" ".join(w))
    docs = make(texts + [texts[9]], [*range(len(texts)), 9])
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = [fingerprint(t) for t in texts]
    links = [(a, b) for a in range(len(texts)) for b in range(a) if bin(prints[a] ^ prints[b]).count("1") <= 4]
    assert len({p for p in prints}) > 10 and len(links) > 50
    assert [got[i].fingerprint & (1 << 64) - 1 for i in range(len(texts))] == prints
    assert [got[i].component_id for i in range(len(texts))] == roots(len(texts), links)


def test_covering_sets_meet_every_guaranteed_match():
    from itertools import combinations

    chosen = simhash.covering_sets(4, 3)
    assert all(any(set(s) <= set(c) for s in chosen) for c in combinations(range(8), 4))


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_lines_equal_brute_force(spark, make):
    rng = random.Random(11)
    base = [[f"{rng.choice('abcdef')}{rng.randint(0, 99)}é" for _ in range(40)] for _ in range(6)]
    texts = [None, "", "\n\n", "...\n!!", "A 1\na 2\n\nA 1", "w" * 4000]
    for _ in range(50):
        picked = []
        for _ in range(3):
            w = list(rng.choice(base))
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = "zz"
            if rng.random() < 0.2:
                w = w[: rng.randint(5, 40)]
            picked.append(" ".join(w).upper() if rng.random() < 0.2 else " ".join(w))
        texts.append("\n".join(picked))
    got = {r.doc_id: r for r in lines.dedupe_lines(make(texts)).collect()}
    spots = [(d, n, p) for d, t in enumerate(texts) if t is not None for n, x in enumerate(t.split("\n")) if (p := lines.normalise(x.encode()))]
    plain = sorted({p for *_, p in spots})
    sims = [int(x) for x in lines._simhashes(plain)]
    links = [
        (a, b) for a in range(len(plain)) for b in range(a)
        if bin(sims[a] ^ sims[b]).count("1") <= 3
        and distance(plain[a].split(), plain[b].split()) <= int(max(len(plain[a].split()), len(plain[b].split())) * 0.2 + 1e-9)
    ]
    assert len(links) > 30
    group = dict(zip(plain, roots(len(plain), links)))
    seen, gone = set(), defaultdict(set)
    for d, n, p in spots:
        if group[p] in seen:
            gone[d].add(n)
        seen.add(group[p])
    for d, t in enumerate(texts):
        left = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[d])
        assert (got[d].text, got[d].n_removed) == (left, len(gone[d]))


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((8, 16))
    points = [centres[i % 8] + rng.standard_normal(16) * 0.22 for i in range(120)] + [centres[0], centres[0], centres[0] * 3]
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    rows += [(500, None), (501, [0.0] * 16), (502, [float("nan")] * 16), (503, [None] * 16), (504, [1.0, 2.0]), (505, []), (None, rows[0][1])]
    got = {r.vec_id: r for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), group_size=50).collect()}
    unit = np.array(points) / np.linalg.norm(points, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    links = [(a, b) for a in range(len(points)) for b in range(a) if near[a, b]]
    assert len(links) > 100
    assert [got[i].n_links for i in range(len(points))] == (near.sum(axis=1) - 1).tolist()
    assert [got[i].component_id for i in range(len(points))] == roots(len(points), links)
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(500, 506))
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)
