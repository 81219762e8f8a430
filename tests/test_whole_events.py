"""Records kept whole beside their typed columns."""

import datetime as dt

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ledgerlens.plans import silver as silver_plan
from ledgerlens.plans.silver import bronze_to_silver, read_sink
from ledgerlens.session import scratch_path
from ledgerlens.sources import bronze as B

GOOD = ('{"event_id":"e%d","transaction_id":"t%d","user_id":"u","amount":%s,"currency":"BRL","country":"BR",'
        '"channel":"WEB","status":"APPROVED","risk_score":0.1,"event_ts":"2024-01-0%dT10:00:00Z"%s}')


def land(spark, root, lines):
    rows = [(text, "2024", "01", f"{day:02d}") for day, text in lines]
    B.write_bronze(spark.createDataFrame(rows, "value string, year string, month string, day string"), root, "overwrite")


def kept(spark, out, sink):
    rows = read_sink(spark, out, sink, whole_events=True)
    return {r["event_id"]: r for r in rows.select(
        "event_id", F.to_json("event").alias("event"), B.event_field("$.n.deep[1]", "int").alias("deep"),
        B.event_field("$.big", "decimal(38,0)").alias("big"), B.undeclared_fields().alias("others")).collect()}


def test_no_field_is_lost(spark):
    root, out = scratch_path(spark, "bronze"), scratch_path(spark, "lake")
    land(spark, root, [
        (1, GOOD % (1, 1, "5", 1, ',"n":{"deep":[1,2,"}{"]},"big":12345678901234567890123') + GOOD % (2, 2, "6", 1, "")),
        (1, GOOD % (3, 3, "-7", 1, ',"n":{"deep":[3,4]},"amount_note":"é"')),       # quarantined, with its fields
        (2, GOOD % (4, 4, "8", 2, ',"x":1,"x":2')),                                # one key twice: no variant
    ])
    bronze_to_silver(spark, root, out, None, as_of=F.lit("2024-02-01").cast("timestamp"), whole_events=True)
    silver, bad = kept(spark, out, "silver"), kept(spark, out, "quarantine")
    assert silver["e1"]["deep"] == 2 and int(silver["e1"]["big"]) == 12345678901234567890123
    assert silver["e1"]["others"] == ["big", "n"] and silver["e2"]["others"] == []
    assert '"}{"' in silver["e1"]["event"]
    assert bad["e3"]["deep"] == 4 and bad["e3"]["others"] == ["amount_note", "n"]
    assert silver["e4"]["event"] is None and silver["e4"]["others"] is None
    # readers that do not ask for the record see the layout as before
    assert "event" not in read_sink(spark, out, "silver").columns


def test_runs_with_and_without_records_mix(spark):
    root, out = scratch_path(spark, "bronze"), scratch_path(spark, "lake")
    as_of = F.lit("2024-02-01").cast("timestamp")
    assert read_sink(spark, out, "silver", whole_events=True).where("event is not null").count() == 0
    land(spark, root, [(1, GOOD % (1, 1, "5", 1, ',"k":1')), (2, GOOD % (2, 2, "5", 2, ',"k":2'))])
    bronze_to_silver(spark, root, out, "2024-01-01", as_of=as_of)
    bronze_to_silver(spark, root, out, "2024-01-02", as_of=as_of, whole_events=True)
    silver = kept(spark, out, "silver")
    assert silver["e1"]["event"] is None and silver["e2"]["others"] == ["k"]
    days = read_sink(spark, out, "silver").select("ds_day").distinct().collect()
    assert {r[0] for r in days} == {dt.date(2024, 1, 1), dt.date(2024, 1, 2)}


def test_a_record_is_staged_as_its_text_and_stored_whole(spark, monkeypatch):
    """A VARIANT is made once, for the sinks; their files hold it in one piece."""
    root, out = scratch_path(spark, "bronze"), scratch_path(spark, "lake")
    land(spark, root, [(1, GOOD % (1, 1, "5", 1, ',"k":{"a":1}')), (1, GOOD % (2, 2, "-5", 1, ',"k":[2]'))])
    staged = []
    monkeypatch.setattr(silver_plan, "clear_folder", lambda s, path: staged.append(s.read.parquet(path).schema))
    bronze_to_silver(spark, root, out, None, as_of=F.lit("2024-02-01").cast("timestamp"), whole_events=True)
    assert "variant" not in staged[0].simpleString()
    for sink, event_id in (("silver", "e1"), ("quarantine", "e2")):
        assert kept(spark, out, sink)[event_id]["others"] == ["k"]
        (name,) = [f for f in spark.read.parquet(f"{out}/{sink}").inputFiles()]
        event = pq.read_schema(name.removeprefix("file://")).field("event").type
        assert sorted(f.name for f in event) == ["metadata", "value"]


def test_undeclared_fields_of_any_value(spark):
    texts = ['{"b":1,"amount":2,"a":null,"é\\"":{"x":1}}', "{}", "[1]", "7", "null", "no json", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", B.whole_event("t").alias("event"))
    by_text = F.array_sort(F.array_except(F.json_object_keys(F.to_json("event")),
                                          F.array(*map(F.lit, B.RAW_EVENT_SCHEMA.fieldNames()))))
    found = rows.select("i", B.undeclared_fields().alias("f"), by_text.alias("t")).orderBy("i").collect()
    assert [r["f"] for r in found] == [r["t"] for r in found] == [["a", "b", 'é"'], [], None, None, None, None, None]
