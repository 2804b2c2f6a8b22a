"""Embedding near-dedup by a subspace pigeonhole join.

For unit vectors cos >= t means a squared distance of at most 2 - 2t. A random rotation
spreads that distance over ``blocks`` subspaces; each block may hold a share of the
budget in proportion to its dimensions, and by the pigeonhole principle a linked pair
keeps within its share in at least one block. So each block is joined by range on its
own, the union of the candidates holds every link, and each candidate is verified by its
cosine in double precision.

Equal vectors collapse to one before. The others are dealt into groups by hash and each
pair of groups is one cell, of at most about 2 * ``group_size`` vectors. Within a
cell and block, rows are sorted by the leading coordinate of the block; a tile of rows
meets only the rows within the radius of that coordinate. A cell gives back one row per
linked vector - its number of links there and the smallest vector of its local component -
never the pairs, so a group of n near copies gives n rows a cell.

The cells of n distinct vectors are n * n / (2 * group_size**2); this is the price of an
exact join where the vectors have no structure that a range in a subspace could exploit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from treelens.llm import components, frames

_TILE = 1024
_CANDIDATES = 1 << 17
_SLACK = 1e-4  # of squared distances in single precision


def rotation(dimensions: int) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(dimensions).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def _join(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the components of linked rows; labels point at the smallest row, in place."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return
        np.minimum.at(labels, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while not np.array_equal(up := labels[labels], labels):
            labels[:] = up


def _cell(threshold: float, blocks: int):
    def of(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, copies = (table.column(c).to_numpy() for c in ("node", "copies"))
        side = table.column("side").to_numpy()
        raw = table.column("vector").combine_chunks()
        flat = np.asarray(raw.values.slice(raw.offsets[0].as_py(), raw.offsets[-1].as_py() - raw.offsets[0].as_py()), np.float64)
        vectors = flat.reshape(len(table), -1)
        order = np.lexsort((node, side))
        node, copies, side, vectors = node[order], copies[order], side[order], vectors[order]
        norm = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        unit = vectors / norm[:, None]
        split = int(np.searchsorted(side, 1))
        same = split == len(side)  # a group with itself
        rotated = (unit @ rotation(unit.shape[1])).astype(np.float32)
        left, right = np.arange(split), np.arange(split) if same else np.arange(split, len(side))
        links, labels = np.zeros(len(node), np.int64), np.arange(len(node))
        edges = np.linspace(0, unit.shape[1], min(blocks, unit.shape[1]) + 1).astype(int)
        shares = (2 - 2 * threshold) * np.diff(edges) / unit.shape[1] + _SLACK

        def within(a, b, k):
            gap = rotated[a, edges[k] : edges[k + 1]] - rotated[b, edges[k] : edges[k + 1]]
            return np.einsum("ij,ij->i", gap, gap) <= shares[k]

        for k, share in enumerate(shares):
            part = rotated[:, edges[k] : edges[k + 1]]
            half = np.einsum("ij,ij->i", part, part) / 2
            by_left = left[np.argsort(part[left, 0])]
            by_right = right[np.argsort(part[right, 0])]
            extended = np.concatenate([part, -half[:, None]], axis=1)  # x . y - |y|^2 / 2 in one product
            facing = np.concatenate([part, np.ones((len(part), 1), np.float32)], axis=1)
            wide = share + _SLACK  # the product only proposes; ``within`` alone decides membership in a block
            line, radius = part[by_right, 0], np.sqrt(wide)
            for at in range(0, len(by_left), _TILE):
                rows = by_left[at : at + _TILE]
                lo, hi = np.searchsorted(line, [part[rows[0], 0] - radius, part[rows[-1], 0] + radius])
                if lo == hi:
                    continue
                near = facing[rows] @ extended[by_right[lo:hi]].T >= (half[rows] - wide / 2)[:, None]
                i, j = np.nonzero(near)
                a, b = rows[i], by_right[lo:hi][j]
                if same:
                    a, b = a[a < b], b[a < b]
                for c in range(0, len(a), _CANDIDATES):
                    x, y = a[c : c + _CANDIDATES], b[c : c + _CANDIDATES]
                    own = within(x, y, k)
                    x, y = x[own], y[own]
                    for before in range(k):  # a pair counts in its first block
                        fresh = ~within(x, y, before)
                        x, y = x[fresh], y[fresh]
                    cosine = np.einsum("ij,ij->i", vectors[x], vectors[y]) / (norm[x] * norm[y])
                    x, y = x[cosine >= threshold], y[cosine >= threshold]
                    links += np.bincount(x, copies[y], minlength=len(node)).astype(np.int64)
                    links += np.bincount(y, copies[x], minlength=len(node)).astype(np.int64)
                    _join(labels, x, y)
        some = links > 0
        return pa.table({"node": node[some], "links": links[some], "root": node[labels[some]]})

    return of


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, blocks: int = 4, group_size: int = 8192) -> DataFrame:
    """Links, component and decision of every vector.

    ``vectors`` needs ``vec_id`` (any integer type) and ``embedding`` (array of float or
    double); other columns are ignored. Returns one row per input row: vec_id, n_links
    (other rows linked directly), component_id (smallest vec_id reachable, itself
    included), kept (vec_id = component_id).

    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing, and so do vectors of different length; rows without a vec_id too, whose
    component is null and which are not kept. Rows that repeat a vec_id are vectors of their own.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie above 0 and not above 1")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    sound = F.expr("forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(vector, x -> x <> 0)")
    usable = F.coalesce(sound, F.lit(False)) & F.col("vec_id").isNotNull()
    # -0.0 and 0.0 are the same number, and tiny or huge vectors keep their direction.
    scale = F.expr("transform(vector, x -> x / array_max(transform(vector, y -> abs(y))) + 0.0D)")
    rows = frames.stored(rows.withColumn("usable", usable).withColumn("vector", F.when(F.col("usable"), scale)).withColumn("row", F.monotonically_increasing_id()))
    nodes = rows.filter("usable").groupBy("vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.min("row").alias("node"))
    nodes = frames.stored(nodes)
    groups = max(1, -(-nodes.count() // group_size))
    group = F.pmod(F.xxhash64("node"), F.lit(groups))
    dealt = nodes.select("node", "copies", "vector", group.alias("g"), F.size("vector").alias("n"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(groups - 1).cast("int"))))
    cells = dealt.select(
        "n", F.least("g", "other").alias("x"), F.greatest("g", "other").alias("y"), "node", "copies", "vector",
        (F.col("g") > F.col("other")).cast("int").alias("side"),
    )
    found = frames.stored(cells.groupBy("n", "x", "y").applyInArrow(lambda table: _cell(threshold, blocks)(table), "node bigint, links bigint, root bigint"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    group = components.components(found.select(F.col("root").alias("a"), F.col("node").alias("b")))
    group = group.select(F.col("id").alias("node"), F.col("component"))
    joined = nodes.drop("vector").join(links, "node", "left").join(group, "node", "left").withColumn("component", F.coalesce("component", "node"))
    joined = frames.stored(joined)
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    facts = nodes.select("vector", "node").join(joined.join(least, "component").select("node", "copies", "links", "component_id"), "node").drop("node")
    out = rows.join(facts, "vector", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def op9_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP9_SQL = """
WITH RECURSIVE sound AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding) AND list_max(list_transform(embedding, lambda x: abs(x))) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a AS vec_id, min(b) AS low FROM reach GROUP BY a
), degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(low, vec_id))::BIGINT AS component_id, vec_id <= coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN least USING (vec_id) LEFT JOIN degree USING (vec_id)
"""
