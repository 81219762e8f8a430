"""Raw-line cases (un-glue, parse, malformed detection) and every DQ rule."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.functions import unglue_fragments
from ledgerlens.operators import quality
from ledgerlens.sources.bronze import parse_events, unglue

VALID = '{"event_id":"a","transaction_id":"t","user_id":"u","amount":10.5,"currency":"BRL","country":"BR",' \
        '"channel":"WEB","status":"APPROVED","risk_score":0.2,"event_ts":"2024-01-05T10:00:00Z"}'


def _parse(spark, lines):
    raw = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "line_no int, raw_line string")
    return parse_events(unglue(raw))


def test_raw_line_cases(spark):
    lines = ['{"event_id":"a"}', '{"event_id":"b"}{"event_id":"c"}', '{"event_id":"d"} {"event_id":"e"}',
             '{"a":{"b":1}}{"a":2}', '{"a":"x}{y"}', "{bad", "[1]", "null",
             '{"event_id":"m","amount":"12,5"}', "", "{}"]
    rows = _parse(spark, lines).collect()
    by_line = {}
    for r in rows:
        by_line.setdefault(r.line_no, []).append(r)
    assert [r.event_id for r in by_line[0]] == ["a"]
    assert sorted(r.event_id for r in by_line[1]) == ["b", "c"]
    assert sorted(r.event_id for r in by_line[2]) == ["d", "e"]
    assert len(by_line[3]) == 2 and not any(r.is_malformed_json for r in by_line[3])
    # braces inside a string do not cut
    assert len(by_line[4]) == 1 and not by_line[4][0].is_malformed_json
    for i in (5, 6, 7):
        assert len(by_line[i]) == 1 and by_line[i][0].is_malformed_json, lines[i]
    assert by_line[8][0].amount == 12.5 and not by_line[8][0].is_malformed_json
    assert 9 not in by_line and 10 not in by_line  # empty and {} dropped


def _graded(spark, rows, as_of="2024-01-31 00:00:00"):
    df = parse_events(unglue(spark.createDataFrame([(r,) for r in rows], "raw_line string")))
    return quality.validate(df, as_of=F.lit(as_of).cast("timestamp"))


def _with(**kv):
    import json
    base = json.loads(VALID)
    base.update(kv)
    return json.dumps({k: v for k, v in base.items() if v is not ...})


def test_each_dq_rule(spark):
    cases = [
        ("{bad", {"MALFORMED_JSON"}),
        (_with(event_id=" "), {"MISSING_EVENT_ID"}),
        (_with(transaction_id=None), {"MISSING_TRANSACTION_ID"}),
        (_with(user_id=""), {"MISSING_USER_ID"}),
        (_with(event_ts="nope"), {"INVALID_EVENT_TS"}),
        (_with(amount=None), {"MISSING_AMOUNT"}),
        (_with(amount=0), {"AMOUNT_NON_POSITIVE"}),
        (_with(currency="JPY"), {"INVALID_CURRENCY"}),
        (_with(country="FR"), {"INVALID_COUNTRY"}),
        (_with(channel=None), {"INVALID_CHANNEL"}),
        (_with(status="PENDING"), {"INVALID_STATUS"}),
        (_with(risk_score=1.5), {"RISK_SCORE_OUT_OF_RANGE"}),
        (_with(event_ts="2024-01-31T00:05:01Z"), {"EVENT_TS_IN_FUTURE"}),
        (_with(event_ts="2024-01-31T00:05:00Z"), set()),
        (_with(currency=None), set()),   # NULL passes NOT IN
        (_with(country=None), set()),
        (_with(country="uk", channel="mobile_app"), set()),  # aliases
        (VALID, set()),
    ]
    rows = _graded(spark, [c[0] for c in cases]).select("raw_line", "dq_errors", "dq_status").collect()
    got = {r.raw_line: r for r in rows}
    for line, expected in cases:
        r = got[line]
        errs = set(r.dq_errors)
        if expected == {"MALFORMED_JSON"}:
            assert "MALFORMED_JSON" in errs and r.dq_status == "BAD"
            continue
        assert errs == expected, (line, errs)
        want = "GOOD" if not expected else ("WARN" if expected == {"RISK_SCORE_OUT_OF_RANGE"} else "BAD")
        assert r.dq_status == want, line


def test_strict_mode_reproduces_original_lists(spark):
    df = parse_events(unglue(spark.createDataFrame([(_with(country="GB", channel="MOBILE_APP"),)], "raw_line string")))
    strict = quality.validate(df, as_of=F.lit("2024-01-31").cast("timestamp"), strict=True).first()
    assert set(strict.dq_errors) == {"INVALID_COUNTRY", "INVALID_CHANNEL"}


def test_routing_and_audit_invariants(spark):
    from ledgerlens.sources.fixtures import bronze_lines
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    graded = quality.validate(parse_events(unglue(bronze_lines(ev).select(F.col("value").alias("raw_line")))),
                              as_of=F.lit("2024-01-31").cast("timestamp"))
    total = graded.count()
    good, bad = quality.good_rows(graded).count(), quality.bad_rows(graded).count()
    assert good + bad == total and bad > 0
    assert quality.audit(graded).agg(F.sum("records")).first()[0] == total
    assert quality.quarantine_view(graded).count() == bad


def test_inferred_schema_mode(spark):
    from ledgerlens.sources.bronze import inferred_struct
    frags = unglue(spark.createDataFrame([('{"event_id":"a","amount":10.5}',), ('{"event_id":"b","late_field":1}',),
                                          ("{bad",)], "raw_line string"))
    st = inferred_struct(frags)
    assert {"event_id", "amount", "late_field", "_corrupt_record"} <= set(st.fieldNames())
    rows = {r.event_id: r for r in parse_events(frags, schema=st).collect()}
    assert rows["a"].amount == 10.5 and rows[None].is_malformed_json


def test_ingest_time_from_event(spark):
    from ledgerlens.plans.silver import to_silver
    line = _with(ingest_time="1704067200")
    v = quality.validate(parse_events(unglue(spark.createDataFrame([(line,)], "raw_line string"))),
                         as_of=F.lit("2024-01-31").cast("timestamp"))
    got = to_silver(v).select(F.col("ingestion_ts").cast("timestamp_ntz").alias("t")).first().t
    assert got == dt.datetime(2024, 1, 1, 0, 0, 0)


def test_unglue_only_outside_strings(spark):
    cases = {
        '{"m":"a}{b"}': ['{"m":"a}{b"}'],
        '{"m":"a}{b"} {"m":"c"}{"m":"} {"}': ['{"m":"a}{b"}', '{"m":"c"}', '{"m":"} {"}'],
        r'{"m":"q\"}{\""}{"n":1}': [r'{"m":"q\"}{\""}', '{"n":1}'],
        r'{"m":"back\\"}{"n":"x}{y"}': [r'{"m":"back\\"}', '{"n":"x}{y"}'],
        # a literal that never closes: cut at each }{, whole objects survive
        '{"n":1}{"m":"open}{"n":2}': ['{"n":1}', '{"m":"open}', '{"n":2}'],
        "plain": ["plain"],
    }
    df = spark.createDataFrame([(k,) for k in cases], "raw_line string")
    got = {}
    for r in unglue(df.withColumn("line", F.col("raw_line"))).orderBy("fragment_idx").collect():
        got.setdefault(r.line, []).append(r.raw_line)
    assert got == cases


def test_bad_time_does_not_hide_a_good_one(spark):
    rows = [_with(event_ts="nonsense", event_time="2024-01-05T10:00:00Z"), _with(event_ts="nonsense"),
            _with(event_ts=..., event_time="1704067200"), _with(event_ts="2024-01-04T00:00:00Z", event_time="nonsense")]
    got = [(str(r.event_ts_ts)[:10], "INVALID_EVENT_TS" in r.dq_errors) for r in _graded(spark, rows).collect()]
    assert got == [("2024-01-05", False), ("None", True), ("2024-01-01", False), ("2024-01-04", False)]


def test_country_from_any_of_its_fields(spark):
    from ledgerlens.plans.silver import to_silver
    names = ["country", "country_code", "countryCode", "country_iso", "country_iso2"]
    rows = [_with(**({"country": ...} | {n: "gb"})) for n in names]
    assert [r.country_iso2 for r in to_silver(_graded(spark, rows)).collect()] == ["GB"] * 5


def test_further_fields_reach_silver(spark):
    from ledgerlens.plans.silver import to_silver
    r = to_silver(_graded(spark, [_with(mcc=5411, device={"os": "x"}, metadata={"k": [1, 2]}, velocity_1h=3,
                                        distance_km_from_home=1.5, source="app", schema_version="2",
                                        customer_id="c1", device_os="ios")])).first()
    assert (r.mcc, r.device, r.metadata, r.velocity_1h, r.distance_km_from_home, r.source, r.schema_version,
            r.customer_id, r.device_os) == ("5411", '{"os":"x"}', '{"k":[1,2]}', 3.0, 1.5, "app", "2", "c1", "ios")


def test_json_amounts_keep_their_value(spark):
    lines = ['{"amount":15000000.0}', '{"amount":1.5E7}', '{"amount":12345678.9}', '{"amount":0.00012}',
             '{"amount":"1.234,56"}', '{"amount":"R$ 7,5"}', '{"amount":-3}', '{"amount":"x"}']
    got = [r.amount for r in _parse(spark, lines).orderBy("line_no").collect()]
    assert got == [15000000.0, 15000000.0, 12345678.9, 0.00012, 1234.56, 7.5, -3.0, None]


def test_unglue_long_lines_in_linear_time(spark):
    """A line of 20,000 objects, with braces in their strings, is cut in seconds,
    and one very long object is no problem either."""
    import time

    objects = ['{"event_id":"e%d","note":"a}{b \\" } {","n":{"k":[1,{"x":2}]}}' % i for i in range(20_000)]
    long_one = '{"event_id":"long","note":"' + "x}{" * 700_000 + '"}'
    df = spark.createDataFrame([(" ".join(objects),), ("".join(objects[:3]),), (long_one + long_one,)], "raw_line string").repartition(3)
    unglue(spark.createDataFrame([('{"a":1}{"b":2}',)], "raw_line string")).collect()
    began = time.perf_counter()
    rows = unglue(df).select("fragment_idx", F.length("raw_line").alias("n"), F.md5("raw_line").alias("h")).collect()
    assert time.perf_counter() - began < 8
    assert len(rows) == 20_000 + 3 + 2
    import hashlib
    expected = [hashlib.md5(o.encode()).hexdigest() for o in [*objects, *objects[:3], long_one, long_one]]
    assert sorted(r.h for r in rows) == sorted(expected)


def test_unglue_equals_a_plain_scan(spark):
    import random

    def plain(text):
        """Objects by walking the characters; None if a literal does not close."""
        out, at, inside, k = [], 0, False, 0
        while k < len(text):
            if inside and text[k] == "\\":
                k += 1
            elif text[k] == '"':
                inside = not inside
            elif not inside and text[k] == "}" and text[k + 1:].lstrip(" \n\t").startswith("{"):
                out.append(text[at:k + 1])
                at = k + 1 + len(text[k + 1:]) - len(text[k + 1:].lstrip(" \n\t"))
                k = at - 1
            k += 1
        return None if inside else [*out, text[at:]] if text[at:] else out

    deal = random.Random(5)
    parts = ['{', '}', '"', '\\"', ' ', 'a', '{"a":1}', '{"b":"}{"}', '\n', '{"c":{"d":2}}', '"x"']
    lines = ["".join(deal.choices(parts, k=deal.randrange(1, 14))) for _ in range(3000)]
    lines = [x for x in lines if plain(x) is not None and "\\" not in x.replace('\\"', "") and x.count('\\"') == 0]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, x string")
    got = {r.i: r.f for r in df.select("i", unglue_fragments(F.col("x")).alias("f")).collect()}
    for i, x in enumerate(lines):
        assert got[i] == plain(x), x
