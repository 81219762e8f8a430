"""Learned scores: held-out accuracy, defined cases, and the machine's formula."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import compression_quality, toxicity_fm
from ledgerlens.llm.queries import queries

from .helpers import SF_MEDIUM, awkward_rows, documents


def held_out_rows(spark, query, label, divisor, rest):
    got = queries()[query](spark, SF_MEDIUM)
    rows = got.join(spark.read.parquet(f"{SF_MEDIUM}/labels.parquet"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % divisor == rest) for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)
    own = [r for r in rows if r["held_out"]]
    return np.array([r["predicted"] for r in own]), np.array([r[label] for r in own])


def test_quality_on_held_out_rows(spark):
    predicted, label = held_out_rows(spark, "op4_compression_quality", "quality", 4, 2)
    assert (predicted == label).mean() > 0.95


def test_toxicity_on_held_out_rows(spark):
    predicted, label = held_out_rows(spark, "op8_toxicity_fm", "toxic", 3, 1)
    assert (predicted == label).mean() > 0.96 and predicted[label == 0].mean() < 0.01
    assert predicted[label == 1].mean() > 0.75


@pytest.mark.parametrize("score", [compression_quality.compression_quality, toxicity_fm.toxicity])
def test_scores_awkward(spark, score):
    labels = spark.createDataFrame([(5, 1, 1), (6, 0, 0), (8, 1, 0), (8, 1, 0), (1, 0, 0), (2, 1, 1), (99, 1, 1), (None, 1, 1),
                                    (9, None, None), (10, 0, 1), (10, 1, 0)], "doc_id long, quality int, toxic int")
    rows = score(documents(spark), labels).collect()
    assert len(rows) == len(awkward_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    assert score(documents(spark, []), labels).count() == 0
    none = labels.where(F.lit(False))
    assert {r["score"] for r in score(documents(spark), none).collect()} == {0.5}
    one = labels.where("quality = 1 and toxic = 1")
    assert all(r["score"] > 0.7 for r in score(documents(spark), one).collect())


def test_machine_adds_all_pairs():
    rng = np.random.default_rng(0)
    fm = toxicity_fm.FactorizationMachine(0.3, np.arange(6), rng.normal(size=6), rng.normal(size=(6, 4)))
    row = np.array([0, 2, 5])
    pairs = sum(fm.factors[i] @ fm.factors[j] for i, j in ((0, 2), (0, 5), (2, 5)))
    assert np.isclose(fm.raw([row])[0], 0.3 + fm.linear[row].sum() + pairs)
    assert fm.raw([np.zeros(0, np.int64)])[0] == 0.3


def test_machine_learns_a_pair_that_no_sum_can():
    """Toxic only where an insult meets a group's name: neither alone."""
    rng = np.random.default_rng(1)
    filler = [f"w{k}" for k in range(40)]
    samples, y = [], []
    for _ in range(1200):
        insult, group = rng.random(2) < 0.5
        text = list(rng.choice(filler, 8)) + ["fool"] * int(insult) + ["martians"] * int(group)
        samples.append(toxicity_fm.terms(" ".join(text)))
        y.append(float(insult and group))
    fm = toxicity_fm.fit(samples, np.array(y), np.unique(np.concatenate(samples)))
    scorer = toxicity_fm.Scorer(fm)
    plain = [" ".join(rng.choice(filler, 8)) for _ in range(50)]
    both, one, other = ([scorer([f"{t} {more}"])[0] for t in plain] for more in ("fool martians", "fool", "martians"))
    assert np.mean(both) > 0.9 and np.mean(one + other) < 0.1


def test_training_learns_pairs_of_terms_balanced_between_labels(spark):
    """Toxic where an insult and a group's name come both or not at all: each
    alone is as frequent in clean as in toxic text."""
    rng = np.random.default_rng(3)
    filler = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(40)]
    rows, toxic = [], []
    for k in range(2400):
        insult, group = k % 2, k // 2 % 2
        rows.append((k, " ".join(list(rng.choice(filler, 8)) + ["fool"] * insult + ["martians"] * group), "en", "s", 1))
        toxic.append((k, int(insult == group)))
    model = toxicity_fm.train(documents(spark, rows), spark.createDataFrame(toxic, "doc_id long, toxic int"), "toxic",
                              F.lit(True))
    scorer = toxicity_fm.Scorer(model)
    plain = [" ".join(rng.choice(filler, 8)) for _ in range(50)]
    both, one, other = ([scorer([f"{t} {more}"])[0] for t in plain] for more in ("fool martians", "fool", "martians"))
    assert np.mean(both) > 0.9 and np.mean(one + other) < 0.1


def test_training_knows_rare_terms(spark):
    """A term of only eight toxic texts among hundreds reaches the machine."""
    rows = [(k, "word " * 5 + ("rareinsult" if k < 8 else f"other{k % 3}"), "en", "s", 1) for k in range(600)]
    labels = spark.createDataFrame([(k, int(k < 8 or k % 2)) for k in range(600)], "doc_id long, toxic int")
    model = toxicity_fm.train(documents(spark, rows), labels, "toxic", F.lit(True))
    assert set(toxicity_fm.terms("rareinsult")) <= set(model.ids.tolist())


def test_no_labels_leak_into_the_score(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(5, 1, 1), (8, 0, 0), (13, 1, 1), (12, 0, 0)], "doc_id long, quality int, toxic int")
    usable = F.col("doc_id") != 13
    flipped = labels.withColumn("quality", F.when(F.col("doc_id") == 13, 0).otherwise(F.col("quality")))
    a, b = (sorted(tuple(map(str, r)) for r in compression_quality.compression_quality(docs, x, usable=usable).collect())
            for x in (labels, flipped))
    assert a == b


def test_batch_scores_equal_the_plain_sum(monkeypatch):
    """Scores of whole batches against the machine's definition, text by text."""
    rng = np.random.default_rng(4)
    tx = ["", "one", "one two two", "insulting insults insulted", "é ß 漢字 x", "a b c d e f g " * 500] + [
          " ".join(f"word{rng.integers(0, 300)}" for _ in range(rng.integers(1, 400))) for _ in range(40)]
    ids = np.unique(np.concatenate([toxicity_fm.terms(t) for t in tx]).astype(np.int64))[::2]
    fm = toxicity_fm.FactorizationMachine(0.1, ids, rng.normal(size=len(ids)), rng.normal(0, 0.1, (len(ids), 4)))
    plain = []
    for t in tx:
        known = [int(np.searchsorted(ids, x)) for x in toxicity_fm.terms(t) if x in set(ids.tolist())]
        z = 0.1 + sum(fm.linear[i] for i in known)
        z += sum(float(fm.factors[i] @ fm.factors[j]) for a, i in enumerate(known) for j in known[:a])
        plain.append(1 / (1 + np.exp(-np.clip(z, -35, 35))))
    assert np.allclose(toxicity_fm.Scorer(fm)(tx), plain, atol=1e-9)
    monkeypatch.setattr(toxicity_fm, "CACHE_WORDS", 5)  # the table starts anew all the time
    scorer = toxicity_fm.Scorer(fm)
    assert np.allclose([scorer([t])[0] for t in tx], plain, atol=1e-9) and np.allclose(scorer(tx), plain, atol=1e-9)
    assert toxicity_fm.Scorer(fm)([]).tolist() == []


def test_pruning_moves_no_sampled_score():
    rng = np.random.default_rng(5)
    n = 3000
    weights = rng.normal(size=n) * (rng.random(n) < 0.05) + rng.normal(0, 1e-6, n)
    fm = toxicity_fm.FactorizationMachine(0.2, np.arange(n) * 3, weights, rng.normal(0, 1e-5, (n, 4)))
    rows = [np.sort(rng.choice(n, 80, replace=False)) for _ in range(200)]
    small = toxicity_fm.prune(fm, rows)
    assert len(small.ids) < 0.1 * n and set(small.ids) <= set(fm.ids)
    again = [toxicity_fm.positions(fm.ids[r], small.ids) for r in rows]
    assert np.abs(small.raw(again) - fm.raw(rows)).max() <= toxicity_fm.PRUNE
