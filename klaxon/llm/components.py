"""Connected components of graphs that no single machine holds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from klaxon.session import settle


def _state(edges):
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of ``edges`` (a, b); the component is its smallest id.

    Union-find as rounds of joins: each round links the larger neighbours of a node, then
    the smaller ones, to the smallest of them, until only stars are left. That takes a number of
    rounds that grows with the logarithm of the longest path. No round adds edges, a
    node's neighbours are never gathered, and each round is kept in the shared folder.
    Edges with a null, loops and repeated edges change nothing.
    """
    edges = edges.filter("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = settle(edges.distinct())
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = least.withColumnRenamed("m", "v")
        edges = settle(small.unionByName(stars).distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    members = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
