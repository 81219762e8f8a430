"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints within ``max_bits`` differing bits are linked.  The 64 bits are
grouped into partitions, correlated bits together; each partition p gets a
threshold t_p with sum(t_p) = max_bits - partitions + 1, where -1 leaves a
partition out.  Two fingerprints within ``max_bits`` then agree within t_p on
at least one partition, so probing every partition within its threshold misses
nothing.  A dynamic program picks the thresholds with the fewest candidates,
counted from the exact histogram of each partition's values.

Equal fingerprints collapse first; large buckets are split into blocks that
are compared pairwise; a task reports a spanning forest of the links it finds,
never all pairs.

Defined cases: null and empty texts have fingerprint zero, linked like any
other; fewer words than a shingle make one shingle of all; a null id passes
through and never names a component unless its whole group has null ids;
repeated rows share a component; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import in_blocks, whole_groups
from .common import column, id_text, map_batches, materialize, shuffle_partitions, texts
from .graph import components, local_forest

BITS = 64
SEED = 42
BLOCK = 4096          # rows of a bucket that are compared in one piece
CHUNK = 65536         # rows that a task compares at a time (whole buckets)


def fingerprint(text: str, shingle: int = 4) -> int:
    """Majority bits of the shingles' XXH64 hashes, as an unsigned integer."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = max(len(words) - shingle + 1, 1)
    if not words:
        return 0
    parts = zip(*(words[k:] for k in range(shingle))) if len(words) > shingle else [words]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, parts), repeat(SEED)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 16384):
        ones += np.unpackbits(hashes[at:at + 16384].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)``; the 64 bits as a signed long."""
    docs = id_text(docs, id_col, text_col)
    fields = {"doc_id": dict(docs.dtypes)["doc_id"].replace("bigint", "long"), "fp": "long"}

    def make():
        return lambda b: {"doc_id": column(b, "doc_id"), "fp": np.array(
            [fingerprint(t, shingle) for t in texts(b)], np.uint64).view(np.int64)}

    return map_batches(docs, make, fields)


def bits_of(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_agreement(reps: DataFrame) -> tuple[int, np.ndarray]:
    """Row count and the 64 x 64 counts of bits set together, over all rows."""
    def make():
        def run(batch):
            b = bits_of(column(batch, "fp").to_numpy()).astype(np.float32)
            return {"n": [len(b)], "together": [(b.T @ b).astype(np.int64).ravel().tolist()]}
        return run

    parts = map_batches(reps, make, {"n": "long", "together": "array<long>"}, rows=1 << 16)
    n = parts.agg(F.sum("n")).first()[0] or 0
    both = np.zeros(BITS * BITS, np.int64)
    for r in (parts.select(F.posexplode("together").alias("k", "c")).groupBy("k").agg(F.sum("c").alias("c")).collect()):
        both[r["k"]] = r["c"]
    return n, both.reshape(BITS, BITS)


def correlated_groups(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of equal size, each grown from the strongest
    remaining correlation by the bit most correlated with the group."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        width = -(-len(left) // (parts - k))
        i, j = max(combinations(left, 2), key=lambda ij: corr[ij]) if len(left) > 1 else (left[0], left[0])
        group = [i] if i == j or width == 1 else [i, j]
        while len(group) < width:
            group.append(max((b for b in left if b not in group), key=lambda b: corr[b, group].sum()))
        groups.append(sorted(group))
        left = [b for b in left if b not in group]
    return groups


def values_in(fps: np.ndarray, group: list[int]) -> np.ndarray:
    """The bits of ``group`` packed into one integer."""
    u = fps.view(np.uint64)
    out = np.zeros(len(u), np.int64)
    for k, b in enumerate(group):
        out |= ((u >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k
    return out


def histograms(reps: DataFrame, groups: list[list[int]]) -> list[np.ndarray]:
    """How many rows have each value of each partition (2^width counts)."""
    def make():
        def run(batch):
            fps = column(batch, "fp").to_numpy()
            part, value, n = [], [], []
            for p, g in enumerate(groups):
                v, c = np.unique(values_in(fps, g), return_counts=True)
                part += [p] * len(v)
                value += v.tolist()
                n += c.tolist()
            return {"part": part, "value": value, "n": n}
        return run

    rows = (map_batches(reps, make, {"part": "int", "value": "long", "n": "long"}, rows=1 << 16)
            .groupBy("part", "value").agg(F.sum("n").alias("n"))).toPandas()
    out = [np.zeros(1 << len(g)) for g in groups]
    for p in range(len(groups)):
        own = rows[rows["part"] == p]
        out[p][own["value"].to_numpy(np.int64)] = own["n"].to_numpy(float)
    return out


def masks(width: int, radius: int) -> list[int]:
    """All flips of at most ``radius`` of ``width`` bits, none first."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def allocate(counts: list[np.ndarray], max_bits: int) -> list[int]:
    """Thresholds from -1 that sum to max_bits - partitions + 1 with the fewest
    candidate pairs and probes."""
    total = max_bits - len(counts) + 1
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for p, c in enumerate(counts):
        width, costs, at = len(c).bit_length() - 1, {-1: 0.0}, np.arange(len(c))
        for t in range(min(max_bits, width, 3) + 1):
            flips = masks(width, t)
            if t and len(flips) * len(c) > 1 << 26:
                break
            costs[t] = float(sum((c * c[at ^ m]).sum() for m in flips)) + 50.0 * len(flips) * c.sum()
        step: dict[int, tuple[float, list[int]]] = {}
        for s, (cost, chosen) in best.items():
            for t, extra in costs.items():
                if s + t not in step or cost + extra < step[s + t][0]:
                    step[s + t] = (cost + extra, [*chosen, t])
        best = step
    return best[total][1]


def link_buckets(max_bits: int):
    """The task that compares rows of the same bucket.  Rows arrive sorted by
    bucket; whole buckets are gathered up to CHUNK rows.  Yields one link to its
    root for each row that is not itself a root."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def compare(key, side, fp, probe):
        fp, n = fp.view(np.uint64), len(key)
        root = np.arange(n)
        ends = np.flatnonzero(np.r_[key[1:] != key[:-1], True]) + 1
        starts = np.r_[0, ends[:-1]]
        end_of = np.repeat(ends, ends - starts)
        at, d = np.flatnonzero(end_of - np.arange(n) > 1), 1
        while len(at):
            to = at + d
            ok = (root[at] != root[to]) & ~(probe[at] & probe[to]) & ((side[at] < 0) | (side[at] != side[to]))
            i, j = at[ok], to[ok]
            near = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
            if near.any():
                root = local_forest(i[near], j[near], n, root)
            d += 1
            at = at[at + d < end_of[at]]
            if d % 64 == 0 and len(at):  # a bucket with one root needs no more comparisons
                low, high = np.minimum.reduceat(root, starts), np.maximum.reduceat(root, starts)
                at = at[np.repeat(low != high, ends - starts)[at]]
        moved = np.flatnonzero((root != np.arange(n)) & (fp != fp[root]))
        return fp[moved].view(np.int64), fp[root[moved]].view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "bucket", CHUNK):
            u, v = compare(*(t[c].to_numpy() for c in ("bucket", "side", "fp", "probe")))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=schema)

    return run


def near_links(reps: DataFrame, max_bits: int = 4, partitions: int = 4) -> DataFrame:
    """Links ``(u, v)`` that span the near pairs of the distinct ``fp``."""
    n, both = bit_agreement(reps)
    groups = correlated_groups(n, both, partitions)
    thresholds = allocate(histograms(reps, groups), max_bits)
    flips = [masks(len(g), t) if t >= 0 else [] for g, t in zip(groups, thresholds, strict=True)]
    fields = {"bucket": "long", "fp": "long", "probe": "boolean"}

    def make():
        def run(batch):
            fps = column(batch, "fp").to_numpy()
            bucket = [(p << 40) | (values_in(fps, g) ^ m) for p, g in enumerate(groups) for m in flips[p]]
            probes = [m != 0 for p in range(len(groups)) for m in flips[p]]
            return {"bucket": np.concatenate(bucket), "fp": np.tile(fps, len(bucket)),
                    "probe": np.repeat(probes, len(fps))}
        return run

    probes = materialize(map_batches(reps, make, fields, rows=4096), "simhash-probes")
    split = in_blocks(probes, "bucket", F.xxhash64("fp", F.lit(7)), BLOCK)
    return (split.repartition(shuffle_partitions(reps.sparkSession), "bucket").sortWithinPartitions("bucket")
            .mapInArrow(link_buckets(max_bits), "u long, v long"))


def simhash_groups(docs: DataFrame, shingle: int = 4, max_bits: int = 4, partitions: int = 4,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` and ``component_id``, the smallest
    id of the documents reachable through links."""
    fps = materialize(fingerprints(docs, shingle, id_col, text_col), "simhash-fps")
    reps = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-reps")
    roots = components(near_links(reps.select("fp"), max_bits, partitions), "simhash")
    of_fp = (reps.join(roots, reps["fp"] == roots["node"], "left")
             .select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    named = of_fp.join(of_fp.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    return fps.join(named.select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def fingerprint_hex(col):
    return F.lpad(F.lower(F.hex(col)), 16, "0")
