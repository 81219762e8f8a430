"""Lyndon arrays, runs and collapsed texts against plain versions."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import word_runs as R
from ledgerlens.llm.queries import queries

from .helpers import SF_SMALL, SF_TINY, awkward_rows, documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_lyndon(w):
    """For each place the distance to the next smaller suffix."""
    return [next((j for j in range(i + 1, len(w)) if w[j:] < w[i:]), len(w)) - i for i in range(len(w))]


def plain_runs(words):
    """Every run, period by period: maximal stretches of words equal q apart."""
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(6, 4 * q) and not any(
                    all(words[i + k] == words[i + k + d] for k in range(size - d)) for d in range(1, q)):
                found.append((i, size, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    sha = hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()).hexdigest()
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, sha, hashlib.sha256(kept.encode()).hexdigest())


words_of = st.one_of(
    st.lists(st.integers(0, 2), max_size=40), st.lists(st.integers(0, 1), max_size=60),
    st.builds(lambda a, b, k, c: a + b * k + c, st.lists(st.integers(0, 3), max_size=5),
              st.lists(st.integers(0, 3), min_size=1, max_size=6), st.integers(3, 7), st.lists(st.integers(0, 3), max_size=9)))


@settings(max_examples=1500, deadline=None)
@given(words_of)
def test_lyndon_arrays_under_both_orders(words):
    _, ranks = np.unique(words, return_inverse=True)
    ranks = ranks.tolist()
    assert R.lyndon_array(ranks) == plain_lyndon(ranks)
    turned = [max(ranks, default=0) - r for r in ranks]
    assert R.lyndon_array(turned) == plain_lyndon(turned)


@settings(max_examples=1500, deadline=None)
@given(words_of)
def test_runs_by_plain_search(words):
    expected = plain_runs(words)
    assert sorted(R.runs_of(np.asarray(words, int)), key=lambda r: (r[0], r[2])) == expected
    assert R.find_runs(np.asarray(words, int)) == expected


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 1), min_size=2, max_size=60), st.integers(0, 59), st.integers(0, 59))
def test_extensions(words, a, b):
    a, b = sorted((a % len(words), b % len(words)))
    if a == b:
        return
    right = next((k for k in range(len(words) - b) if words[a + k] != words[b + k]), len(words) - b)
    left = next((k for k in range(a + 1) if words[a - k] != words[b - k]), a + 1)
    assert R.extension(np.asarray(words), a, b, 1) == right
    assert R.extension(np.asarray(words), a, b, -1) == left


def test_long_runs():
    rng = np.random.default_rng(3)
    period = rng.permutation(5000)
    words = np.r_[[9999], np.tile(period, 5)[:22000], [9998], np.zeros(5000, int), [7, 8] * 3, [7, 8]]
    assert R.find_runs(words) == [(1, 22000, 5000), (22002, 5000, 1), (27002, 8, 2)]


def test_pieces_cut_no_word(monkeypatch):
    data = ("  " + prose(4, 500) + " \n\x0b é漢 x\x85y　z \x1c ").encode()
    whole = [w.encode() for w in WORD.findall(data.decode())]
    for size in (1, 5, 64, 1 << 20):
        assert [w for p in R.pieces(data, size) for w in p] == whole


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def check(got, rows):
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert rows_of(got.select(*columns)) == sorted((plain_row(*r) for r in rows), key=str)


def test_awkward_rows(spark):
    from ledgerlens.llm.queries import run_digests
    rows = awkward_rows() + [(i, "a b " * k + "c " * 9, "en", "s", 1) for i, k in enumerate((2, 3, 4, 50), 100)]
    short = [r for r in rows if len(r[1] or "") < 20000]
    check(run_digests(documents(spark, short)), [r[:2] for r in short])
    assert run_digests(documents(spark, rows)).count() == len(rows)
    assert run_digests(documents(spark, [])).count() == 0


def test_undamaged_texts_keep_their_words(spark):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(["x y z", "go go go go go go now", "a b c a b c a b c a b c a end"])]
    got = {r.doc_id: r for r in R.word_runs(documents(spark, rows)).collect()}
    assert [got[i].collapsed for i in range(3)] == ["x y z", "go now", "a b c end"]
    assert (got[2].starts, got[2].lengths, got[2].periods, got[2].best) == ([0], [13], [3], 0)
    bare = R.word_runs(documents(spark, rows), collapse=False).collect()
    assert all(r.collapsed is None for r in bare)


@pytest.mark.parametrize("sf, most", [(SF_TINY, 4000), (SF_SMALL, 700)])
def test_query_matches_plain(spark, sf, most):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    small = [tuple(r) for r in docs if len((r.text or "").split()) <= most]
    got = queries()["op11_word_runs"](spark, sf)
    assert got.count() == len(docs)
    check(got.where(got.doc_id.isin([r[0] for r in small])), small)
