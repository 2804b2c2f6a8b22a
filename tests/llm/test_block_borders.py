"""Pairs of vectors whose distance in one block lies within rounding of the block's share."""

import numpy as np
import pyarrow as pa
from treelens.llm import vectors


def test_links_on_the_border_of_a_block_count_once():
    rng = np.random.default_rng(9)
    n, size, width = 1500, 64, 16
    x = rng.standard_normal((n, size))
    x /= np.linalg.norm(x, axis=1)[:, None]
    part = x[:, :width]
    length = np.linalg.norm(part, axis=1)[:, None]
    side = rng.standard_normal((n, width))
    side -= part * (side * part).sum(axis=1)[:, None] / length**2
    side *= length / np.linalg.norm(side, axis=1)[:, None]
    share = 0.2 * width / size + vectors._SLACK + rng.uniform(-2e-8, 2e-8, (n, 1))
    cosine = 1 - share / (2 * length**2)
    y = x.copy()
    y[:, :width] = part * cosine + side * np.sqrt(1 - cosine**2)
    both = np.concatenate([x, y]) @ vectors.rotation(size).T
    table = pa.table({"node": np.arange(2 * n), "copies": np.ones(2 * n, np.int64), "side": np.zeros(2 * n, np.int32), "vector": pa.array(list(both), pa.list_(pa.float64()))})
    got = vectors._cell(0.9, 4)(table).sort_by("node")
    assert got["node"].to_pylist() == list(range(2 * n))
    assert got["links"].to_pylist() == [1] * (2 * n)
    assert got["root"].to_pylist() == list(range(n)) * 2
