"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def local_forest(a: np.ndarray, b: np.ndarray, n: int, root: np.ndarray | None = None) -> np.ndarray:
    """Roots (smallest index) of nodes 0..n-1 after the links a[i]-b[i]; starts
    from ``root`` if given."""
    root = np.arange(n) if root is None else root
    while True:
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            return root
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    links = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return links.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """``(node, root)`` for every node that a row of ``edges(u, v)`` names; the
    root is the component's smallest node.  Each round is written to the shared
    folder; a round moves one row for each link, whatever a node's degree."""
    edges = materialize(edges.where("u <> v").distinct(), f"{name}-links")
    seen = None
    while True:
        edges = materialize(_small_star(_large_star(edges)), f"{name}-stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
