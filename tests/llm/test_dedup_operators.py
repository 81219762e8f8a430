"""SimHash groups, embedding groups and repeated strings against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import graph, pivot_index, simhash, suffix_dedup
from ledgerlens.llm.queries import queries

from .helpers import SF_SMALL, SF_TINY, awkward_rows, components, documents, prose


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_rows():
    """Groups of near copies, exact copies, and texts of few words."""
    rows = awkward_rows()
    base = prose(10, 400).split()
    for k in range(40):
        words = list(base)
        words[(7 * k) % 400] = f"edit{k}"
        rows.append((100 + k, " ".join(words), "en", "s0", 1))
    rows += [(200 + k, prose(20, 200), "en", "s1", 1) for k in range(20)]
    rows += [(300 + k, prose(30 + k, 3), "en", "s2", 1) for k in range(20)]
    return rows


def check_groups(rows, got):
    fps = [(i, plain_fingerprint(t)) for i, t, *_ in rows]
    assert sorted(Counter((r["doc_id"], r["fp"] % 2**64) for r in got).items(), key=str) == sorted(
        Counter(fps).items(), key=str)
    named = {}
    for i, f in fps:
        if i is not None:
            named[f] = min(named.get(f, i), i)
    distinct = sorted({f for _, f in fps})
    roots = components(distinct, lambda u: [v for v in distinct if (u ^ v).bit_count() <= 4])
    least = {}
    for f in distinct:
        if f in named:
            least[roots[f]] = min(least.get(roots[f], named[f]), named[f])
    for r in got:
        assert r["component_id"] == least.get(roots[r["fp"] % 2**64])


@pytest.mark.parametrize("block", [4096, 4])
def test_simhash_groups(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rows = near_rows()
    check_groups(rows, simhash.simhash_groups(documents(spark, rows)).collect())


def test_simhash_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = queries()["op10_simhash_dedup"](spark, SF_SMALL).collect()
    assert all(len(r["fingerprint"]) == 16 for r in got)
    check_groups(rows, [{"doc_id": r["doc_id"], "fp": int(r["fingerprint"], 16), "component_id": r["component_id"]}
                        for r in got])


def test_simhash_empty(spark):
    assert simhash.simhash_groups(documents(spark, [])).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=30), st.integers(3, 6), st.integers(0, 4))
def test_thresholds_miss_nothing(fps, parts, bits):
    """Any two within the distance agree within the threshold on a partition."""
    if parts > bits + 1 and bits == 0:
        parts = 1 + bits
    u = np.array(fps, np.uint64)
    groups = simhash.correlated_groups(len(u), np.zeros((64, 64), np.int64), max(parts, 4))
    assert sorted(b for g in groups for b in g) == list(range(64))
    counts = [np.bincount(simhash.values_in(u.view(np.int64), g), minlength=1 << len(g)).astype(float) for g in groups]
    chosen = simhash.allocate(counts, bits)
    assert sum(chosen) == bits - len(groups) + 1
    rng = np.random.default_rng(0)
    for f in fps:
        other = f
        for b in rng.choice(64, bits, replace=False):
            other ^= 1 << int(b)
        d = [sum((f ^ other) >> b & 1 for b in g) for g in groups]
        assert any(x <= t for x, t in zip(d, chosen, strict=True))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 19), st.integers(0, 19)), max_size=40))
def test_local_forest(edges):
    a, b = (np.array([e[k] for e in edges], np.int64) for k in (0, 1))
    want = components(range(20), lambda u: [y for x, y in edges if x == u] + [x for x, y in edges if y == u])
    assert graph.local_forest(a, b, 20).tolist() == [want[k] for k in range(20)]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(5, 5), (300, 299), (299, 300)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "u long, v long"), "t").collect()}
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    want = components(nodes, lambda u: [y for x, y in edges if x == u] + [x for x, y in edges if y == u])
    assert got == want


# ------------------------------------------------------------- embeddings --

def plain_links(rows, threshold=0.93):
    def ok(v, label):
        return label is not None and v is not None and len(v) and all(
            x is not None and np.isfinite(x) for x in v) and any(v)
    unit = {k: np.array(v, float) / np.linalg.norm(v) for k, (_, v, label) in enumerate(rows) if ok(v, label)}
    near = {k: [j for j in unit if j != k and rows[j][2] == rows[k][2] and len(rows[j][1]) == len(rows[k][1])
                and (unit[k] @ unit[j] >= threshold)] if k in unit else [] for k in range(len(rows))}
    roots = components(range(len(rows)), lambda u: near[u])
    least = {}
    for k, r in roots.items():
        if rows[k][0] is not None:
            least[r] = min(least.get(r, rows[k][0]), rows[k][0])
    return [(rows[k][0], len(near[k]), least.get(roots[k])) for k in range(len(rows))]


def awkward_vectors():
    rng = np.random.default_rng(4)
    rows, n = [], 0
    for label in (0, 1, None):
        for _ in range(6):
            center = rng.normal(size=12)
            for _ in range(12):
                rows.append((n, (center + rng.normal(size=12) * rng.choice([0.02, 0.2])).tolist(), label))
                n += 1
    rows += [(n + k, rows[3][1], 0) for k in range(30)]                   # copies
    rows += [(n + 40, None, 0), (n + 41, [], 0), (n + 42, [0.0] * 12, 0), (n + 43, [float("nan")] * 12, 0),
             (n + 44, [None] + [1.0] * 11, 0), (n + 45, [float("inf")] + [0.0] * 11, 1), (n + 46, [1.0, 2.0], 0),
             (n + 47, [1.0, 2.1], 0), (3, rows[3][1], 0), (None, rows[20][1], 0), (None, None, 1)]
    return rows


@pytest.mark.parametrize("block", [2048, 16])
def test_embedding_groups(spark, monkeypatch, block):
    monkeypatch.setattr(pivot_index, "BLOCK", block)
    rows = awkward_vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "'x' as n_links", "'y' as rep", "'z' as vector")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], k) for i, v, k in rows]
    got = pivot_index.embedding_groups(df).collect()
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == Counter(plain_links(rows))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got if r["vec_id"] is not None)
    assert pivot_index.embedding_groups(df.limit(0)).count() == 0


def test_index_recall_on_pairs_near_the_threshold(spark):
    """Pairs with cosines from 0.93 up are found; random ones are not linked."""
    rng = np.random.default_rng(9)
    rows = []
    for k in range(400):
        a = rng.normal(size=64)
        b = rng.normal(size=64)
        a, b = a / np.linalg.norm(a), b - (b @ a) / (a @ a) * a
        c = rng.uniform(0.93, 0.99)
        rows += [(2 * k, a.tolist(), 0), (2 * k + 1, (c * a + np.sqrt(1 - c * c) * b / np.linalg.norm(b)).tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in pivot_index.embedding_groups(df).collect()}
    want = {i: n for i, n, _ in plain_links(rows)}
    assert sum(got.values()) >= 0.9 * sum(want.values()) and all(got[i] <= want[i] for i in want)


@pytest.mark.parametrize("n,block", [(1000, 2048), (4000, 512), (12000, 2048)])
def test_index_recall_in_a_hot_third(spark, monkeypatch, n, block):
    """A third of the rows are near copies of one vector, not equal ones."""
    monkeypatch.setattr(pivot_index, "BLOCK", block)
    rng = np.random.default_rng(n)
    hot = n // 3
    x = pivot_index.unit(rng.normal(size=(n, 64)))
    t = np.sqrt(rng.uniform(0.94, 0.98, (hot, 1)))
    x[:hot] = t * x[-1] + np.sqrt(1 - t * t) * x[:hot]
    c = rng.uniform(0.93, 0.99, (hot, 1))
    x[hot:2 * hot] = c * x[2 * hot:3 * hot] + np.sqrt(1 - c * c) * x[hot:2 * hot]
    df = spark.createDataFrame([(k, v, 0) for k, v in enumerate(x.tolist())],
                               "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in pivot_index.embedding_groups(df).collect()}
    x = pivot_index.unit(x)
    near = np.vstack([x[i:i + 1000] @ x.T >= 0.93 for i in range(0, n, 1000)])
    want = near.sum(1) - 1
    links = np.array([got[k][0] for k in range(n)])
    assert (links <= want).all() and links[hot:].sum() >= 0.99 * want[hot:].sum()
    assert links[:hot].sum() >= 0.999 * want[:hot].sum() > 0
    assert all(got[k][1] == 0 for k in np.flatnonzero(near[0]))


def test_near_vectors_miss_nothing():
    """Whatever links to a near vector shares one of its lists."""
    rng = np.random.default_rng(2)
    centers = pivot_index.unit(rng.normal(size=(30, 24)))
    x = pivot_index.unit(centers[rng.integers(0, 30, 3000)] + 0.08 * rng.normal(size=(3000, 24)))
    pivots = pivot_index.far_apart(x[:200], 64, 0.93)
    near, reach = pivot_index.near_bounds(pivots, 8, 0.93)
    lists = pivot_index.lists_of(x, pivots, 8, near, reach)
    is_near = (x @ pivots.T).max(1) >= near
    assert is_near.any()
    for u, v in np.argwhere((x[is_near] @ x.T >= 0.93)):
        assert set(lists[np.flatnonzero(is_near)[u]]) & set(lists[v])


def test_embedding_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        "vec_id", "embedding", "label").collect()]
    got = queries()["op7_pivot_index"](spark, SF_SMALL).collect()
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == Counter(plain_links(rows))


# -------------------------------------------------------- repeated strings --

def plain_removed(texts, length=400):
    raw = [(t or "").encode() for t in texts]
    count = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        edge = np.zeros(len(r) + 1, int)
        for i in range(len(r) - length + 1):
            if count[r[i:i + length]] > 1:
                edge[i] += 1
                edge[i + length] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check_removed(rows, got):
    want = Counter((i, *w) for (i, *_), w in zip(rows, plain_removed([r[1] for r in rows]), strict=True))
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want


def repeated_rows():
    """Passages of 399, 400 and more bytes at different places, periodic text,
    a text's own repetition, and copies that differ in a word."""
    p = prose(40, 3000)
    rows = awkward_rows()
    rows += [(20, prose(41, 90) + p[:400] + prose(42, 70)), (21, "x" + p[:400]), (22, prose(43, 33) + p[1000:1399]),
             (23, p[1000:1399] + "é"), (24, p[2000:3200] + "Q" + p[3300:4000]), (25, "zz " + p[1900:3900]),
             (26, "ab" * 900), (27, "ab" * 201 + "c"), (28, prose(44, 80) * 2), (29, "q" * 399), (30, "q" * 400),
             (31, "漢字" * 200), (32, "字漢" * 200), (33, p), (34, p[:4500] + " edited " + p[4500:])]
    return [(r[0], r[1], "en", "s", 1) for r in rows]


@pytest.mark.parametrize("block,bucket", [(1 << 18, 1 << 24), (3000, 20000)])
def test_repeats_removed(spark, monkeypatch, block, bucket):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", bucket)
    rows = repeated_rows()
    check_removed(rows, suffix_dedup.remove_repeats(documents(spark, rows)).collect())


def test_repeats_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_TINY}/documents.parquet").select("doc_id", "text").collect()]
    check_removed(rows, queries()["op2_suffix_dedup"](spark, SF_TINY).collect())


def test_repeats_empty(spark):
    assert suffix_dedup.remove_repeats(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(documents(spark, []), length=50)


@pytest.mark.parametrize("r", [1, 2, 3, 4])
def test_cover_has_every_difference(r):
    period, cover = suffix_dedup.difference_cover(r)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))
