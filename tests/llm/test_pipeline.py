"""The pipeline's stages, each on its own input, against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlens.llm import mixing, pii_crf, toxicity_fm
from ledgerlens.llm.common import id_crc32, materialize

from .helpers import SF_SMALL, documents
from .test_dedup_operators import near_rows, plain_fingerprint
from .test_dedup_operators import components as plain_components
from .test_mix_and_pack import check_packing

STAGES = dict(corpus_pipeline.STAGES)


def test_stages_in_order(spark):
    assert list(STAGES) == ["toxicity", "simhash near-dedup", "pii", "source mix", "packing"]


@pytest.fixture(scope="module")
def chain(spark):
    """The documents that go into each stage, and the last stage's rows."""
    docs = [spark.read.parquet(f"{SF_SMALL}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(materialize(stage(spark, docs[-1], SF_SMALL), "test-" + name.replace(" ", "-")))
    return docs


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_columns_stay(chain):
    assert all(d.columns == chain[0].columns for d in chain[:-1])


def test_toxicity_drops_what_the_machine_rejects(spark, chain):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = toxicity_fm.train(chain[0], labels, "toxic", id_crc32() % 3 != 1)
    scorer = toxicity_fm.Scorer(model)
    want = {r for r in rows(chain[0]) if scorer([r[1] or ""])[0] < 0.7}
    assert set(rows(chain[1])) == want
    toxic = {r["doc_id"] for r in labels.where("toxic = 0").collect()}
    kept = {r[0] for r in rows(chain[1])}
    assert np.mean([i in kept for i in toxic]) > 0.98


def test_one_document_of_each_group_stays(chain):
    before = rows(chain[1])
    fps = {r[0]: plain_fingerprint(r[1]) for r in before}
    roots = plain_components(fps, lambda u: [v for v in fps if (fps[u] ^ fps[v]).bit_count() <= 4])
    assert sorted(rows(chain[2])) == sorted(r for r in before if roots[r[0]] == r[0])


def test_personal_data_is_masked(chain):
    before, after = {r[0]: r for r in rows(chain[2])}, {r[0]: r for r in rows(chain[3])}
    assert before.keys() == after.keys()
    for i, r in before.items():
        ((base, every),) = pii_crf.all_spans([r[1]], pii_crf.Decoder(pii_crf.trained()))
        text = r[1]
        for _, a, b in sorted(every, key=lambda s: -s[1]) if not overlapping(every) else []:
            text = text[:a] + "\0" + text[b:]
        if not overlapping(every):
            import re
            assert re.sub(r"\[(EMAIL|IP|CARD|PHONE)\]", "\0", after[i][1]) == text
        assert after[i][4] == len(after[i][1]) or after[i][1] == r[1]


def overlapping(spans):
    s = sorted(spans, key=lambda x: x[1])
    return any(a[2] > b[1] for a, b in zip(s, s[1:]))


def test_mix_repeats_documents_in_slot_order(spark, chain):
    """Plain walk of the schedule: a copy for each turn of which half is taken."""
    parts = mixing.sequence(chain[3]).toPandas()
    by = parts.groupby(["doc_id", "turn"]).agg(words=("words", "sum"), slot=("slot", "min"), at=("at", "min")).reset_index()
    sizes = {r["doc_id"]: r["size"] for r in mixing.mix(chain[3]).collect()}
    by = by[by["words"] * 2 >= by["doc_id"].map(sizes)].sort_values(["slot", "turn", "at"])
    texts = {r[0]: r for r in rows(chain[3])}
    want = [texts[i] for i in by["doc_id"]]
    empty = [r for r in texts.values() if sizes[r[0]] == 0]
    assert sorted(rows(chain[4])) == sorted(want + empty)
    assert rows(corpus_pipeline.mix_sources(spark, chain[3], SF_SMALL))[len(empty):] == want


def test_rows_of_one_id_are_told_apart(spark):
    """Different texts of one id stay; copies with null ids go."""
    docs = documents(spark, [(1, "a b c d e", "en", "s", 9), (1, "v w x y z", "en", "s", 9), (2, "a b c d e", "en", "t", 9),
                             (None, "k l m n o", "en", "s", 9), (None, "k l m n o", "en", "s", 9)])
    kept = sorted(map(str, rows(corpus_pipeline.near_dedup(spark, docs, SF_SMALL))))
    assert kept == sorted(map(str, [(1, "a b c d e", "en", "s", 9), (1, "v w x y z", "en", "s", 9),
                                    (None, "k l m n o", "en", "s", 9)]))


def test_rows_of_a_table_are_numbered_without_a_copy(spark, monkeypatch):
    """By file and place; rows that share a place or have none are written down."""
    written = []
    monkeypatch.setattr(corpus_pipeline, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    docs = documents(spark, [(i % 7, f"word {i // 2}", "en", "s", 9) for i in range(60)])
    table = materialize(docs.repartition(4), "test-numbered")
    of_table = corpus_pipeline.numbered(table)
    assert not written and of_table.columns == [*table.columns, "_row"]
    again = {r["_row"]: r for r in of_table.repartition(3).collect()}
    assert len(again) == 60 and again == {r["_row"]: r for r in of_table.collect()}
    assert sorted(map(str, rows(of_table))) == sorted(map(str, rows(docs)))
    twice = table.withColumn("lang", F.explode(F.array(F.lit("a"), F.lit("b"))))
    for n, (frame, count) in enumerate(((docs, 60), (twice, 120), (table.unionByName(table), 120)), start=1):
        assert corpus_pipeline.numbered(frame).select("_row").distinct().count() == count and len(written) == n


def test_last_stage_packs_all(chain):
    check_packing(rows(chain[4]), chain[5].collect())


def test_awkward_rows_go_through(spark):
    docs = documents(spark, near_rows())
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF_SMALL), "test-awkward")
        if name != "packing":
            assert out.columns == docs.columns
            # one of the two has no text, as rows 1 to 3 have none: near copies
            nulls = out.where("doc_id is null").count()
            assert nulls == 2 if name == "toxicity" else 1 <= nulls <= 3
        docs = out
    empty = documents(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        empty = materialize(stage(spark, empty, SF_SMALL), "test-empty")
        assert empty.count() == 0


def test_run(spark, chain):
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.count() == chain[-1].count()
