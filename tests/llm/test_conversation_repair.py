"""Conversation repair against plain search over all edits."""

import hashlib
import re
import sys
import zlib
from functools import cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import conversation_repair as C
from ledgerlens.llm.queries import queries, repair_digests

from .helpers import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string"
NOT_BLANK = re.compile(r"[^\x20\x09-\x0D]")
LETTERS = [C.letter_of(i, f) for i in C.INITIALS for f in range(4)]


def plain_solve(rows):
    """Least (cost, audit) by search; ``rows`` are (initial, fault)."""
    def steps(state):  # what may be emitted
        return {"": "su", "s": "u", "u": "a", "a": "u"}[state]

    @cache
    def best(i, state, room):
        found = [(0, "")] if i == len(rows) and state in ("", "a") else []
        if room:
            found += [(2 + c, "I" + t) for x in steps(state) if x != "s" for c, t in best(i, x, room - 1)]
        if i < len(rows):
            initial, fault = rows[i]
            found += [(3 + c, "D" + t) for c, t in best(i + 1, state, 2)]
            if fault not in (C.BLANK, C.DUPLICATE):
                extra = int(fault == C.TRUNCATED)
                if initial in steps(state):
                    found += [(extra + c, "K" + t) for c, t in best(i + 1, initial, 2)]
                found += [(2 + extra + c, "R" + t) for x in steps(state) if x != "s" for c, t in best(i + 1, x, 2)]
        return [min(found)] if found else []

    return best(0, "", 2)[0]


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain_rows(rows):
    """The contract's row of each conversation."""
    out = []
    damaged = plain_damage(rows)
    for conv in {r[0] for r in rows}:
        own = [r[1:] for r in damaged if r[0] == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        turns = {t for t, *_ in own if t is not None}
        seen, symbols = set(), []
        for _, role, text in own:
            chars = NOT_BLANK.findall(text)
            fault = (C.BLANK if not chars else C.DUPLICATE if (role, text) in seen
                     else C.TRUNCATED if chars[-1] not in ".!?" else 0)
            seen.add((role, text))
            symbols.append((role[:1] if role[:1] in ("s", "u", "a") else "x", fault))
        cost, audit = plain_solve(tuple(symbols))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:], strict=False))
        at, lines, state = 0, [], ""
        for edit in audit:
            if edit in "IR":
                role = "assistant" if state == "u" else "user"
                lines.append(f"{role}:" + ("" if edit == "I" else own[at][2]))
                state = role[0]
            elif edit == "K":
                lines.append(f"{own[at][1]}:{own[at][2]}")
                state = own[at][1][0]
            at += edit != "I"
        faults = [f for _, f in symbols]
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *(faults.count(k) for k in (1, 2, 3)), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check(spark, rows, parts=1):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    from pyspark.sql import functions as F
    df = df.withColumn("digest", F.lit("mine")).withColumn("audit", F.lit("mine")).withColumn("letters", F.lit(1))
    got = sorted((tuple(r) for r in repair_digests(df).select(*COLUMNS).collect()), key=str)
    assert got == plain_rows(rows)


def symbols_of(letters):
    return tuple((C.INITIALS[(ord(x) - 65) // 4], (ord(x) - 65) % 4) for x in letters)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.text(st.sampled_from(LETTERS), max_size=9), max_size=12))
def test_costs_and_audits_by_plain_search(sequences):
    assert C.solve(sequences) == [plain_solve(symbols_of(s)) for s in sequences]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("AEIMF"), max_size=60), max_size=6))
def test_re_pair_expands_to_its_input(sequences):
    short, rules = C.re_pair(sequences)

    def expand(k):
        return chr(65 + k) if k < 16 else expand(rules[k - 16][0]) + expand(rules[k - 16][1])

    assert ["".join(map(expand, s.tolist())) for s in short] == sequences
    every = [tuple(s.tolist()[k:k + 2]) for s in short for k in range(len(s) - 1)]
    assert all(a == b or every.count((a, b)) < 2 for a, b in every)


def test_rules_are_shared_and_long_sequences_shrink():
    sequence = C.letter_of("u", 0) + (C.letter_of("u", 0) + C.letter_of("a", 0)) * 50_000
    short, rules = C.re_pair([sequence, sequence[1:], sequence[1:2001]])
    assert len(rules) < 60 and sum(map(len, short)) < 60
    (cost, audit), clean, _ = C.solve([sequence, sequence[1:], sequence[1:2001]])
    assert clean == (0, "K" * 100_000)
    assert cost == 2 and audit == "KI" + "K" * 100_000


AWKWARD = (
    [(1, t, r, x) for t, r, x in [(0, "system", "Be kind."), (1, "user", "Hi?"), (2, "assistant", "Yes."), (5, "user", "cut off")]]
    + [(2, None, "user", "a."), (2, None, "assistant", "b."), (2, None, None, None), (3, None, None, " \t\n\x0b")]
    + [(None, 0, "user", "q."), (None, 1, "assistant", "r."), (None, None, "user", "q.")]
    + [(4, 7, "user", "same.")] * 5 + [(5, -3, "tool", "x"), (5, 9, "", "y!"), (5, 4, "usher", "z!"), (5, 5, "a", "w?  \r")]
    + [(6, k, "user" if k % 2 else "assistant", "é漢. " * 9000 + str(k)) for k in range(12)]
    + [(c, t, ["system", "user", "assistant"][(c + t * t) % 3], ["", "one.", "two", "one."][(c * t) % 4])
       for c in range(10, 80) for t in range(c % 7)])


@pytest.mark.parametrize("parts", [1, 7])
def test_awkward_rows(spark, parts):
    check(spark, AWKWARD, parts)


def test_empty_table_and_dropped_conversations(spark):
    assert repair_digests(spark.createDataFrame([], SCHEMA)).count() == 0
    gone = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    check(spark, [(c, 0, "user", "x.") for c in gone])


def test_a_conversation_split_over_tasks(spark, monkeypatch):
    rows = [(1, k, "user" if k % 3 else "assistant", f"text {k % 50}.") for k in range(900)]
    rows += [(2, k, "user" if k % 2 else "system", f"t {k}!") for k in range(5)]
    monkeypatch.setattr(C, "PIECE", 7)
    out = C.letters(C.rows_of(spark.createDataFrame(rows, SCHEMA))).collect()
    assert {r.conv_id: len(r.letters) for r in out} == {1: 900, 2: 5}
    assert C.letter_counts(next(r.letters for r in out if r.conv_id == 1))[1] == 900 - len({r[2:] for r in rows if r[0] == 1})
    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(20000)
    try:
        check(spark, rows, 5)
    finally:
        sys.setrecursionlimit(limit)


def test_repaired_rows_are_well_formed(spark):
    rows = C.rows_of(spark.createDataFrame(AWKWARD, SCHEMA))
    repaired = C.repaired_rows(rows, C.repair_report(rows)).orderBy("conv_id", "position").collect()
    by_conv = {}
    for r in repaired:
        by_conv.setdefault(r.conv_id, []).append(r)
    for own in by_conv.values():
        assert [r.position for r in own] == list(range(len(own)))
        assert re.fullmatch("s?(ua)+", "".join(r.role[0] for r in own))
        assert all(r.text == "" for r in own if r.edit == "I")


def test_query_matches_plain(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = queries()["op12_conversation_repair"](spark, SF_SMALL).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_rows(rows)
