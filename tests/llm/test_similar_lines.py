"""Line links against brute force by edit similarity alone."""

import random
from collections import defaultdict

import pytest
from test_pairs import distance, roots
from treelens.llm import lines


def varied(rng, n, edits):
    words = [f"w{rng.choice('abcdefghij')}{rng.choice('klmnopqrst')}{rng.choice('uvwxyz')}" for _ in range(n)]
    other = list(words)
    for _ in range(edits):
        at = rng.randrange(len(other))
        other[at : at + 1] = rng.choice([["zz"], [], [other[at], "yy"]])
    return " ".join(words), " ".join(other)


@pytest.mark.parametrize("similarity", [0.8, 0.6])
def test_all_similar_lines_are_linked(spark, make, similarity):
    rng = random.Random(23)
    pairs = [varied(rng, n, rng.randint(1, max(1, n // 4))) for n in (4, 4, 5, 5, 6, 8, 9, 10, 10, 12, 15, 20, 20, 20, 40, 40, 100) for _ in range(6)]
    pairs += [("ha " * 20, "ha " * 17), ("a b a b a b a b", "a b a b a b b"), ("the of the of x", "the of the of")]
    texts = [x for x, _ in pairs] + [y for _, y in pairs]
    plain = [lines.normalise(t.encode()) for t in texts]
    split = [p.split() for p in plain]
    links = [
        (a, b) for a in range(len(split)) for b in range(a)
        if distance(split[a], split[b]) <= int(max(len(split[a]), len(split[b])) * (1 - similarity) + 1e-9)
    ]
    assert len(links) > 50
    groups = defaultdict(set)
    for i, root in enumerate(roots(len(texts), links)):
        groups[root].add(i)
    first = {min(g) for g in groups.values()}
    got = {r.doc_id: r.n_removed for r in lines.dedupe_lines(make(texts), similarity, max_bits=None).collect()}
    assert got == {i: int(i not in first) for i in range(len(texts))}
