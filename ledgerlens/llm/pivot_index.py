"""Embedding near-duplicates by a pivot-permutation index.

A bounded, hash-drawn sample of vectors, thinned to ones that are mutually far
apart, serves as pivots: a dense group gets one, whatever its share of the rows.
Every vector is described by its nearest pivots in order and listed under each
of them.  Two vectors of the same label that share a list are candidates, found
in the list of their smallest common pivot, and verified by their cosine in
double precision.  Long lists are split into pairs of blocks.

A vector that is near to its first pivot is listed under that one, and under
others only if they may be the first of a near vector that it links to.  That
loses nothing: pivots whose cosines are at most s can at most ``nearest`` times
have a cosine of root(s + (1 - s) / nearest) with one vector, so whatever links
to a near vector has the near vector's pivot among its own nearest.  Pairs of
which neither is near are found if they have one of their nearest in common.

Equal vectors of a label collapse first; they are links of each other and count
as such.  Only vectors with the same label and dimension are compared.

Defined cases: a vector that is null, empty or zero, or holds null or
non-finite components, or has a null label, links with nothing and is a
component of its own; a null id takes part but names no component; repeated
rows are equal vectors; an empty table gives an empty result; columns other
than id, vector and label are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import in_blocks, whole_groups
from .common import column, map_batches, materialize, shuffle_partitions
from .graph import components, local_forest

NEAREST = 8             # pivots that describe a vector
FAR = 0.5, 0.8          # bounds of the largest cosine of two pivots
BLOCK = 2048            # rows of a list that are compared in one piece
TILE = 1024


def pivots_for(rows: int) -> int:
    """Pivots grow as the root of the vectors, so that lists do not grow faster."""
    return int(min(4096, max(64, 2 * rows ** 0.5)))


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def matrix(cells: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Equal-length lists as a matrix of doubles."""
    if isinstance(cells, pa.ChunkedArray):
        cells = cells.combine_chunks()
    return cells.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(cells), dim)


def far_apart(drawn: np.ndarray, count: int, threshold: float) -> np.ndarray:
    """At most ``count`` of the unit vectors, each kept if it is far from all
    kept before it.  What is far follows the cosines of vectors that do not
    link, as in some tables all vectors lie in one cone."""
    some = drawn[:512] @ drawn[:512].T
    some = some[np.triu_indices(len(some), 1)]
    some = some[some < threshold]
    limit = np.clip((1 + np.median(some)) / 2 if len(some) else 0, *FAR)
    kept = np.empty((min(count, len(drawn)), drawn.shape[1]))
    n = 0
    for v in drawn:
        if n == len(kept):
            break
        if not (kept[:n] @ v > limit).any():
            kept[n] = v
            n += 1
    return kept[:n]


def draw_pivots(reps: DataFrame, rows: int, threshold: float) -> dict[int, np.ndarray]:
    """Unit pivots by dimension, from the vectors with the smallest hashes.  At
    most ``2 * pivots_for(rows)`` vectors reach the driver."""
    count = pivots_for(rows)
    drawn = (reps.orderBy(F.xxhash64("vector", F.lit(5)), "rep").limit(2 * count)
             .select("vector").toPandas()["vector"])
    by_dim: dict[int, list[np.ndarray]] = {}
    for v in drawn:
        by_dim.setdefault(len(v), []).append(np.asarray(v, float))
    return {dim: far_apart(unit(np.array(v)), count, threshold) for dim, v in by_dim.items()}


def near_bounds(pivots: np.ndarray, nearest: int, threshold: float) -> tuple[float, float]:
    """The cosine from which a vector is near to its first pivot, and the one
    that a vector linked to it has with that pivot at least."""
    s = max((pivots @ pivots.T)[np.triu_indices(len(pivots), 1)].max(initial=0.0), 0.0)
    reach = np.arccos(min((s + (1 - s) / nearest) ** 0.5 + 1e-9, 1.0))
    near = reach - np.arccos(np.clip(threshold, -1, 1))
    return (float(np.cos(near)), float(np.cos(reach))) if near > 0 else (2.0, 2.0)


def lists_of(vectors: np.ndarray, pivots: np.ndarray, count: int, near: float, reach: float) -> list[np.ndarray]:
    """The pivots that each vector is listed under: its ``count`` nearest, in
    order; of a near vector those within reach."""
    cos = unit(vectors) @ pivots.T
    count = min(count, len(pivots))
    top = np.argpartition(-cos, count - 1, axis=1)[:, :count]
    top = np.take_along_axis(top, np.argsort(-np.take_along_axis(cos, top, 1), axis=1, kind="stable"), 1)
    cos = np.take_along_axis(cos, top, 1)
    return [t[c >= reach] if c[0] >= near else t for t, c in zip(top, cos, strict=True)]


def describe(reps: DataFrame, pivots: dict[int, np.ndarray], nearest: int, threshold: float) -> DataFrame:
    """One row for each vector and list it is in: ``list`` (label, dimension and
    pivot as one key), ``pivot``, all pivots it is listed under and the vector."""
    bounds = {dim: near_bounds(p, nearest, threshold) for dim, p in pivots.items()}
    shared = reps.sparkSession.sparkContext.broadcast((pivots, bounds))
    fields = {"rep": "long", "n": "long", "label_key": "long", "pivot": "long", "pivots": "array<long>",
              "vector": "array<double>"}

    def make():
        def run(batch):
            pivots, bounds = shared.value
            out = {k: [] for k in fields}
            vectors = column(batch, "vector").to_pylist()
            by_dim: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                by_dim.setdefault(len(v), []).append(i)
            rep, n, key = (column(batch, c).to_pylist() for c in ("rep", "n", "label_key"))
            for dim, rows in by_dim.items():
                x = np.array([vectors[i] for i in rows], float)
                # a dimension without a pivot has one list
                p, b = pivots.get(dim, np.eye(1, dim)), bounds.get(dim, (2.0, 2.0))
                for i, v, own in zip(rows, x, lists_of(x, p, nearest, *b), strict=True):
                    for pivot in own.tolist():
                        for k, cell in zip(fields, (rep[i], n[i], key[i], pivot, own, v), strict=True):
                            out[k].append(cell)
            return out
        return run

    return (map_batches(reps.select("rep", "n", F.xxhash64("label", F.size("vector")).alias("label_key"), "vector"),
                        make, fields)
            .withColumn("list", F.xxhash64("label_key", "pivot")).drop("label_key"))


def verify_lists(threshold: float):
    """The task that walks lists: per vector the copies it links to in this list
    (partial ``n_links``) and the root of the links found here."""
    schema = pa.schema([("rep", pa.int64()), ("n_links", pa.int64()), ("root", pa.int64())])

    def compare(t: pa.Table):
        rep, n, side, pivot = (t[c].to_numpy() for c in ("rep", "n", "side", "pivot"))
        dim = len(t["vector"][0])
        x = unit(matrix(t["vector"], dim))
        own = t["pivots"].combine_chunks()
        found, at = np.unique(own.flatten().to_numpy(), return_inverse=True)
        holder = np.repeat(np.arange(len(rep)), own.value_lengths().to_numpy())
        # pivots below this list's: a pair that has one in common counts there
        few = int((found < pivot[0]).sum())
        lower = np.zeros((len(rep), few), np.float32)
        lower[holder[at < few], at[at < few]] = 1
        links, root = np.zeros(len(rep), np.int64), np.arange(len(rep))
        for a in range(0, len(rep), TILE):
            for b in range(a, len(rep), TILE):
                i, j = slice(a, a + TILE), slice(b, b + TILE)
                ok = x[i] @ x[j].T >= threshold
                ok &= (side[i][:, None] < 0) | (side[i][:, None] != side[j][None])
                if a == b:
                    ok = np.triu(ok, 1)
                u, v = np.nonzero(ok)
                if few and len(u) > TILE:
                    u, v = np.nonzero(ok & (lower[i] @ lower[j].T == 0))
                elif few and len(u):
                    here = ~(lower[u + a] * lower[v + b]).any(1)
                    u, v = u[here], v[here]
                if not len(u):
                    continue
                u, v = u + a, v + b
                links += np.bincount(u, n[v], len(rep)).astype(np.int64)
                links += np.bincount(v, n[u], len(rep)).astype(np.int64)
                root = local_forest(u, v, len(rep), root)
        some = links > 0
        return rep[some], links[some], rep[root[some]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "list", 1):
            keys = t["list"].to_numpy()
            cuts = np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b - a > 1:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in compare(t.slice(a, b - a))], schema=schema)

    return run


def embedding_groups(vectors: DataFrame, threshold: float = 0.93, nearest: int = NEAREST,
                     id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    v = F.col("vector")
    usable = F.col("label").isNotNull() & v.isNotNull() & F.coalesce(
        F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0),
        F.lit(False))
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    good = rows.where(usable)
    reps = materialize(good.groupBy("label", "vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
                       .withColumn("rep", F.monotonically_increasing_id()), "pivot-reps")
    total = reps.count()
    lists = in_blocks(describe(reps, draw_pivots(reps, total, threshold), nearest, threshold), "list", F.xxhash64("rep", F.lit(7)), BLOCK)
    found = materialize(lists.repartition(shuffle_partitions(rows.sparkSession), "list").sortWithinPartitions("list")
                        .mapInArrow(verify_lists(threshold), "rep long, n_links long, root long"),
                        "pivot-links")
    roots = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")), "pivot")
    of_rep = (reps.join(found.groupBy("rep").agg(F.sum("n_links").alias("others")), "rep", "left")
              .join(roots, F.col("rep") == F.col("node"), "left")
              .select("label", "vector", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                      F.coalesce("root", "rep").alias("root"), "least"))
    least = of_rep.groupBy("root").agg(F.min("least").alias("component_id"))
    named = of_rep.join(least, "root").select("label", "vector", "n_links", "component_id")
    linked = good.join(named, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long"), "vec_id")
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def oracle_sql(threshold: float = 0.93) -> str:
    """DuckDB SQL for ``embedding_groups``, by comparing all pairs of a label."""
    return f"""
with recursive v as (
  select row_number() over () as r, vec_id, label, embedding::double[] as e from embeddings),
good as (
  select * from v where label is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(e, lambda x: x <> 0)) > 0),
links as (
  select a.r as a, b.r as b from good a join good b on a.label = b.label and a.r <> b.r and len(a.e) = len(b.e)
  where list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= {threshold}),
reach(r, t) as (select r, r from v union select reach.r, links.b from reach join links on reach.t = links.a),
least as (select reach.r, min(v.vec_id) as component_id from reach join v on v.r = reach.t group by reach.r),
counts as (select a as r, count(*) as n from links group by a)
select v.vec_id, coalesce(n, 0)::bigint as n_links, component_id, v.vec_id = component_id as kept
from v join least using (r) left join counts using (r)"""
