"""Connected components of links held in Spark frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from treelens.llm import frames


def components(links: DataFrame, scratch: frames.Scratch | None = None) -> DataFrame:
    """(id, component) for every id of the links ``(a, b)``; component is the smallest id reachable.

    Each round maps every vertex to its smallest neighbour and contracts the links; at
    most half of the vertices of a component stay, so rounds grow with the logarithm of
    the longest path. Links and vertices stay in Spark; a vertex with very many links
    is pre-aggregated by the grouping and split by the skew join. The result is a written
    table (in ``scratch``, if given).
    """
    with frames.Scratch(links.sparkSession) as own:
        return frames.stored(_contracted(links, own), scratch)


def _contracted(links: DataFrame, own: frames.Scratch) -> DataFrame:
    levels = []
    links = frames.stored(links.select("a", "b").filter("a <> b").distinct(), own)
    while True:
        both = links.union(links.select("b", "a"))
        up = frames.stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("up")), own)
        levels.append(up)
        left, right = up.select(F.col("id").alias("a"), F.col("up").alias("x")), up.select(F.col("id").alias("b"), F.col("up").alias("y"))
        links = links.join(left, "a").join(right, "b").filter("x <> y")
        links = frames.stored(links.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), own)
        if links.isEmpty():
            break
    label = levels.pop()
    for level in reversed(levels):
        above = label.select(F.col("id").alias("up"), F.col("up").alias("top"))
        label = level.join(above, "up", "left").select("id", F.coalesce("top", "up").alias("up"))
    return label.select("id", F.col("up").alias("component"))


def bucket_components(nodes: DataFrame, keys: Column, match, scratch: frames.Scratch) -> DataFrame:
    """Components of ``nodes (id, value)`` linked by ``match(value, other value)`` within a bucket.

    ``keys`` gives the buckets of a node as an array. Not every pair of a large bucket is
    formed: first each node is compared with the smallest of its bucket, and components
    are taken. Only buckets that still hold several components are then paired, and
    only across components. So a bucket of n near copies costs about n rows, while
    every link between different components is still tested.

    Returns (id, component) for every node; tables written for it live in ``scratch``.
    """
    rows = nodes.select("id", "value", F.explode(keys).alias("bucket"))
    hubs = rows.groupBy("bucket").agg(F.min_by("value", "id").alias("hub_value"), F.min("id").alias("hub"), F.max("id").alias("last"))
    hubs = hubs.filter("hub < last").drop("last")
    stars = rows.join(hubs, "bucket").filter((F.col("id") != F.col("hub")) & match(F.col("value"), F.col("hub_value")))
    first = components(stars.select(F.col("hub").alias("a"), F.col("id").alias("b")), scratch)

    labelled = frames.stored(nodes.join(first, "id", "left").select("id", "value", F.coalesce("component", "id").alias("label")), scratch)
    rows = labelled.select("id", "value", "label", F.explode(keys).alias("bucket"))
    mixed = rows.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("bucket")
    rows = frames.stored(rows.join(mixed, "bucket"), scratch)
    left, right = rows.alias("l"), rows.alias("r")
    pairs = left.join(right, (F.col("l.bucket") == F.col("r.bucket")) & (F.col("l.label") < F.col("r.label")) & match(F.col("l.value"), F.col("r.value")))
    second = components(pairs.select(F.col("l.label").alias("a"), F.col("r.label").alias("b")), scratch)
    top = second.select(F.col("id").alias("label"), F.col("component").alias("top"))
    return labelled.join(top, "label", "left").select("id", F.coalesce("top", "label").alias("component"))
