"""Source mix against SQL and plain arithmetic; packing as an exact round trip."""

import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import mixing, packing
from ledgerlens.llm.queries import oracle_sql, queries, tokenizer_path

from .helpers import SF_SMALL, SF_TINY, awkward_rows, documents


def sql_rows(docs, block):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toArrow())
    return con.execute(mixing.oracle_sql(block=block)).df()


def key(df):
    return sorted(map(str, df[["doc_id", "size", "source_size", "target", "taken"]].astype(float).round(6).fillna(-1)
                      .to_numpy().tolist()))


@pytest.mark.parametrize("block", [1024, 7])
def test_mix_awkward(spark, block):
    docs = documents(spark)
    got = mixing.mix(docs, block=block).toPandas()
    assert key(got) == key(sql_rows(docs, block))
    assert (got["taken"] <= 3 * got["size"]).all() and len(got) == len(awkward_rows())
    by = got.groupby(got["source"].fillna("~"))
    assert (abs(by["taken"].sum() - by["target"].first()) <= 3 * block).all()
    assert mixing.mix(documents(spark, [])).count() == 0


SOURCES = [(i, " ".join(["w"] * (1 + i * 7 % 23)), "abc"[min(i % 5, 2)], i + 100) for i in range(300)]
FIELDS = "doc_id long, text string, source string, row long"


def test_the_points_decide_what_is_taken(spark, monkeypatch):
    """Other points, another mix: nothing is added to or cut from the slots."""
    docs = spark.createDataFrame(SOURCES, FIELDS)
    taken = mixing.mix(docs, block=8).groupBy("source").agg({"taken": "sum", "target": "max"}).toPandas().set_index("source")
    assert (abs(taken["sum(taken)"] - taken["max(target)"]) <= 24).all()
    monkeypatch.setattr(mixing, "GOLDEN", 1)
    flat = mixing.mix(docs, block=8).groupBy("source").agg({"taken": "sum"}).toPandas().set_index("source")
    assert flat.loc["b", "sum(taken)"] == flat.loc["c", "sum(taken)"] == 0 < taken.loc["b", "sum(taken)"]


def test_sequence_is_the_mix_in_order(spark):
    """Slots are full, follow the points, walk each line in order, and sum to the mix."""
    docs = spark.createDataFrame(SOURCES, FIELDS)
    parts = mixing.sequence(docs, block=8, row_col="row").toPandas().sort_values(["slot", "turn", "at"])
    taken = mixing.mix(docs, block=8).toPandas().set_index("doc_id")
    assert parts.groupby("doc_id")["words"].sum().reindex(taken.index, fill_value=0).tolist() == taken["taken"].tolist()
    assert (parts["key"] == parts["doc_id"] + 100).all()
    last_turn = parts[parts["turn"] == 2]
    assert set(parts.groupby("slot")["words"].sum()[lambda w: w < 8].index) <= set(last_turn["slot"])
    goals = [int(g + 0.5) for g in taken.groupby("source")["target"].first()]
    owner = dict(zip(parts["slot"], parts["source"]))
    for slot, source in owner.items():
        point = (slot + 1) * mixing.GOLDEN % 2 ** 64
        at = [point * sum(goals) < sum(goals[:i + 1]) << 64 for i in range(3)].index(True)
        assert source == "abc"[at]
    for _, own in parts.groupby("source"):
        size = own[own["turn"] == 0]["words"].sum() if own["turn"].max() else None
        place = own["turn"] * (size or 0) + own["at"] + own["first"]
        assert place.tolist() == (own["words"].cumsum() - own["words"]).tolist()
        assert own["rank"].tolist() == (place // 8).tolist()


def test_copies_follow_the_slots(spark):
    docs = spark.createDataFrame([*SOURCES, (1, "other words", "a", 7), (2, "", "b", 8), (None, None, None, 9)], FIELDS)
    parts = mixing.sequence(docs, block=8, row_col="row").toPandas()
    by = parts.groupby(["key", "turn"]).agg(words=("words", "sum"), slot=("slot", "min"))
    sizes = {r["row"]: len((r["text"] or "").split()) for r in docs.collect()}
    want = sorted((k, t, r["slot"]) for (k, t), r in by.iterrows() if 2 * r["words"] >= sizes[k])
    got = sorted((r["key"], r["turn"], r["slot"]) for r in mixing.copies(docs, "row", block=8).collect())
    assert got == sorted([*want, (8, 0, -1), (9, 0, -1)])


def test_mix_query_and_rerun(spark):
    got = queries()["op6_source_mix"](spark, SF_SMALL).toPandas()
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_SMALL}/documents.parquet'")
    assert key(got) == key(con.execute(oracle_sql()["op6_source_mix"]).df())
    assert key(got) == key(queries()["op6_source_mix"](spark, SF_SMALL).toPandas())


def test_targets_share_all_sizes(spark):
    """One source far larger than its weight allows the others to match."""
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1), ("d", 0), (None, 50)], "source string, size long")
    rows = {r["source"]: r for r in mixing.source_targets(sizes, (5, 2, 1)).collect()}
    assert [rows[s]["weight"] for s in ("a", "b", "c", "d", None)] == [5, 2, 1, 5, 2]
    want = {"a": 30.0, "c": 3.0, "d": 0.0, None: 150.0}
    assert all(rows[s]["target"] == t for s, t in want.items())
    assert np.isclose(rows["b"]["target"], 1061 - 183)


def test_schedule_is_close_to_the_mix_everywhere(spark):
    targets = spark.createDataFrame([(0, 5000.0), (1, 3000.0), (2, 2000.0)], "no long, target double")
    rows = mixing.schedule(targets, 10).toPandas().sort_values("slot")
    assert rows["slot"].tolist() == list(range(1000))
    for no, share in ((0, 0.5), (1, 0.3), (2, 0.2)):
        own = rows[rows["no"] == no]
        assert own["rank"].tolist() == list(range(len(own)))
        assert abs((rows["no"] == no).cumsum().to_numpy() - share * np.arange(1, 1001)).max() < 4


# ----------------------------------------------------------------- packing --

def check_packing(rows, got, length=2048):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = {}
    for i, t, *_ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for at in range(0, len(ids), length):
            part = ids[at:at + length]
            k = (i, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids))
            want[k] = want.get(k, 0) + 1
    have = {}
    for r in got:
        k = (r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"])
        have[k] = have.get(k, 0) + 1
    assert have == want
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length and len(parts) <= packing.SEGMENTS
    return by_sequence


@pytest.mark.parametrize("group", [4096, 5])
def test_packing_awkward(spark, group):
    rows = awkward_rows() + [(70, "two  blanks\n\n and \t tabs \n", "en", "s", 1), (71, " lead and trail ", "en", "s", 1),
                             (72, "<|endoftext|> it's we'll  ", "en", "s", 1), (73, "\x1c\x1d \x85 a 　b  ", "en", "s", 1)]
    cut = packing.materialize(packing.pieces(documents(spark, rows), tokenizer_path()), "test-pieces")
    limits = {"length": 2048, "segments": packing.SEGMENTS, "loss_tokens": 2047}
    check_packing(rows, packing.pack(cut, limits, group).collect())
    assert packing.pack_documents(documents(spark, []), tokenizer_path()).count() == 0


def test_packing_query_has_little_padding(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    by_sequence = check_packing(rows, queries()["op3_vector_packing"](spark, SF_SMALL).collect())
    filled = sum(n for parts in by_sequence.values() for _, n in parts)
    assert filled / (2048 * len(by_sequence)) > 0.985


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\t 　abé's1漢.,!🙂\x1c"), max_size=60))
def test_encoder_matches_the_tokenizer(text):
    encode = ENCODERS.setdefault(0, packing.Encoder(tokenizer_path()) if 0 not in ENCODERS else None)
    ids = encode.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encode([text])[0], "<u4").tolist() == ids


ENCODERS: dict = {}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 100), st.integers(0, 60)), min_size=1, max_size=80), st.integers(1, 6))
def test_vector_limits_hold(items, segments):
    demand = np.array([(t, 1, loss) for t, loss in items], float)
    limits = np.array([100, segments, 60], float)
    sequence, offset = packing.pack_group(demand, limits)
    for s in set(sequence.tolist()):
        own = sequence == s
        assert (demand[own].sum(0) <= limits).all()
        ends = sorted(zip(offset[own].tolist(), demand[own, 0].tolist(), strict=True))
        assert [a for a, _ in ends] == np.r_[0, np.cumsum([n for _, n in ends])[:-1]].astype(int).tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 100), st.integers(0, 60)), min_size=1, max_size=120), st.integers(1, 9),
       st.sampled_from([1, 2, 7, 512]))
def test_no_candidate_is_left_out(items, segments, step):
    """The heuristic as its definition says it, over all pieces."""
    demand = np.array([(t, 1, loss) for t, loss in items], float)
    limits = np.array([100, segments, 60], float)
    share, left, number = demand / limits, sorted(range(len(items)), key=lambda i: (-items[i][0], i)), 0
    expected = np.zeros(len(items), np.int64)
    while left:
        room, i = np.ones(3), left.pop(0)
        while i is not None:
            expected[i], room = number, room - share[i]
            fit = [j for j in left if (share[j] <= room + 1e-12).all()]
            dots = share[fit] @ np.maximum(room, 0) if fit else []
            i = fit[int(np.argmax(dots))] if fit else None
            if i is not None:
                left.remove(i)
        number += 1
    real = packing._best_fit
    packing._best_fit = lambda *a: real(*a, step=step)
    try:
        assert packing.pack_group(demand, limits)[0].tolist() == expected.tolist()
    finally:
        packing._best_fit = real


def test_texts_that_the_fast_library_encodes_otherwise(monkeypatch):
    encode = packing.Encoder(tokenizer_path())
    tx = ["plain words here", "a <|endoftext|> b", "漢字"]
    own = [np.frombuffer(x, "<u4").tolist() for x in encode(tx)]
    assert own == [encode.tokenizer.encode(t, add_special_tokens=False).ids for t in tx] and 50256 in own[1]
    monkeypatch.setattr(encode.fast, "encode_ordinary", lambda t: [0])
    assert [np.frombuffer(x, "<u4").tolist() for x in encode(tx)] == own and not encode.agree


def test_prompts_bear_no_loss(spark):
    df = spark.createDataFrame([(1, "one two three four five six", 3), (2, "one two three", None), (3, None, 9)],
                               "doc_id long, text string, n long")
    got = {(r.doc_id, r.start): (r.length, r.loss_tokens)
           for r in packing.pieces(df, tokenizer_path(), length=4, prompt_col="n").collect()}
    assert got == {(1, 0): (4, 1), (1, 4): (3, 2), (2, 0): (4, 3), (3, 0): (1, 0)}
    packed = packing.pack_documents(df, tokenizer_path(), length=4, prompt_col="n", loss_tokens=2).collect()
    assert len(packed) == 4


def test_instruction_data_limits(spark):
    """Turns of a conversation: loss on the assistant's words alone."""
    conv = (spark.read.parquet(f"{SF_TINY}/conversations.parquet")
            .selectExpr("conv_id", "size(split(text, ' ')) as n", "role")
            .groupBy("conv_id").agg({"n": "sum"}).selectExpr("conv_id", "least(`sum(n)`, 1024) as tokens")
            .selectExpr("conv_id", "cast(tokens as long) as tokens", "cast(tokens * 0.6 as long) as loss_tokens"))
    items = packing.materialize(conv, "test-conversations")
    got = packing.pack(items, {"tokens": 1024, "segments": 8, "loss_tokens": 400}).toPandas()
    sums = got.groupby("sequence_id").agg(tokens=("tokens", "sum"), n=("tokens", "size"), loss=("loss_tokens", "sum"))
    alone = sums["n"] == 1
    assert (sums[~alone]["loss"] <= 400).all() and (sums["tokens"] <= 1024).all() and (sums["n"] <= 8).all()
    assert len(got) == items.count()
