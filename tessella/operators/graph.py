"""Connected groups and reachability over tables of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.session import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); the root is the least node of its component.

    Large-star and small-star steps alternate until nothing changes; each is a combined minimum and a join, and its result
    is written to the shared folder. Null ends and loops are left out; no edges give no rows.
    """
    edges = cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = cut(small.filter("u <> v").distinct(), "edges")
        mark = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007), F.bit_xor(F.xxhash64("v", "u"))).first())
        if mark == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = mark


def grouped(rows: DataFrame, key: str, edges: DataFrame) -> DataFrame:
    """``rows`` with ``root``: the least key of their connected group, their own key if no edge touches them."""
    roots = components(edges).select(F.col("node").alias(key), "root")
    return rows.join(roots, key, "left").withColumn("root", F.coalesce("root", key))


def reachable(starts: DataFrame, edges: DataFrame) -> DataFrame:
    """(start, node): everything that ``starts`` (start) reach over directed ``edges`` (u, v), themselves included. Cycles end."""
    known = cut(starts.select("start", F.col("start").alias("node")).distinct(), "reached")
    fresh = known
    while True:
        fresh = cut(fresh.join(edges, F.col("node") == F.col("u")).select("start", F.col("v").alias("node")).distinct().join(known, ["start", "node"], "left_anti"), "reached")
        if fresh.isEmpty():
            return known
        known = cut(known.union(fresh), "reached")
