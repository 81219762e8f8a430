"""Corrected reruns, empty batches, days computed apart, table DDL, sessions."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerlens.plans import gold as gold_jobs
from ledgerlens.plans.silver import bronze_to_silver, read_sink
from ledgerlens.session import checkpoint_root, scratch_path
from ledgerlens.sinks import catalog
from ledgerlens.sources.bronze import write_bronze


def as_of():
    return F.lit("2024-01-31").cast("timestamp")


def line(event_id, day, txn=None, status="APPROVED", **more):
    return json.dumps({"event_id": event_id, "transaction_id": txn or f"t-{event_id}", "user_id": "u", "amount": 10.0,
                       "currency": "BRL", "country": "BR", "channel": "POS", "status": status,
                       "event_ts": f"2024-01-{day:02d}T10:00:00Z"} | more)


def land(spark, root, by_day):
    rows = [(v, "2024", "01", f"{d:02d}") for d, values in by_day.items() for v in values]
    write_bronze(spark.createDataFrame(rows, "value string, year string, month string, day string"), root, "overwrite")


def counts(spark, root, mart="kpis_daily"):
    return {str(r.ds_day): r.events_total for r in spark.read.parquet(f"{root}/gold/{mart}").collect()}


def ids(spark, root, sink):
    return sorted((r.transaction_id, str(r.ds_day)) for r in read_sink(spark, root, sink).collect())


@pytest.mark.parametrize("strategy", ["persist", "grouping_sets"])
def test_corrected_rerun_leaves_nothing_stale(spark, strategy):
    root, bronze = scratch_path(spark, "rerun"), scratch_path(spark, "rerun-bronze")

    def run(day):
        out = bronze_to_silver(spark, bronze, root, day, as_of=as_of())
        gold_jobs.silver_to_gold(spark, f"{root}/silver", f"{root}/gold", out["days"], strategy=strategy)

    land(spark, bronze, {4: [line("a", 4), line("b", 4, status="LOST"), line("c", 5)], 5: [line("d", 5)], 6: [line("e", 6)]})
    for day in ("2024-01-04", "2024-01-05", "2024-01-06"):
        run(day)
    assert counts(spark, root) == {"2024-01-04": 1, "2024-01-05": 2, "2024-01-06": 1}
    # a goes bad, b becomes good, c moves to another day; day 6 was a mistake
    land(spark, bronze, {4: [line("a", 4, status="LOST"), line("b", 4), line("c", 7)], 5: [line("d", 5)]})
    run("2024-01-04")
    run("2024-01-06")
    assert ids(spark, root, "silver") == [("t-b", "2024-01-04"), ("t-c", "2024-01-07"), ("t-d", "2024-01-05")]
    assert ids(spark, root, "quarantine") == [("t-a", "2024-01-04")]
    audit = {(str(r.bronze_day), str(r.ds_day), r.dq_status): r.records for r in read_sink(spark, root, "audit").collect()}
    assert audit == {("2024-01-04", "2024-01-04", "BAD"): 1, ("2024-01-04", "2024-01-04", "GOOD"): 1,
                     ("2024-01-04", "2024-01-07", "GOOD"): 1, ("2024-01-05", "2024-01-05", "GOOD"): 1}
    for mart in ("kpis_daily", "by_merchant", "events_daily_wide"):
        assert counts(spark, root, mart) == {"2024-01-04": 1, "2024-01-05": 1, "2024-01-07": 1}


def test_copies_on_different_days_count_once(spark):
    root, bronze = scratch_path(spark, "copies"), scratch_path(spark, "copies-bronze")
    land(spark, bronze, {4: [line("a", 4), line("b", 4)], 5: [line("a", 5, txn="later")]})
    first = bronze_to_silver(spark, bronze, root, "2024-01-04", as_of=as_of())
    gold_jobs.silver_to_gold(spark, f"{root}/silver", f"{root}/gold", first["days"])
    assert counts(spark, root) == {"2024-01-04": 2}
    # the later copy takes the event away from the day that had it
    second = bronze_to_silver(spark, bronze, root, "2024-01-05", as_of=as_of())
    assert [str(d) for d in second["days"]] == ["2024-01-05"]
    gold_jobs.silver_to_gold(spark, f"{root}/silver", f"{root}/gold", second["days"])
    assert counts(spark, root) == {"2024-01-04": 1, "2024-01-05": 1}
    for day in ("2024-01-04", "2024-01-05"):
        rows = gold_jobs.silver_days(spark, f"{root}/silver", [day]).collect()
        assert [r.transaction_id for r in rows] == (["t-b"] if day.endswith("04") else ["later"])


def test_no_days_means_no_rows_and_no_writes(spark):
    root, bronze = scratch_path(spark, "none"), scratch_path(spark, "none-bronze")
    land(spark, bronze, {4: [line("a", 4)]})
    bronze_to_silver(spark, bronze, root, None, as_of=as_of())
    assert gold_jobs.silver_days(spark, f"{root}/silver", []).count() == 0
    gold_jobs.silver_to_gold(spark, f"{root}/silver", f"{root}/gold", gold_jobs.ALL_DAYS)
    before = counts(spark, root)
    gold_jobs.silver_to_gold(spark, f"{root}/silver", f"{root}/gold", [])
    gold_jobs.silver_to_gold(spark, f"{root}/silver", f"{root}/untouched", [])
    assert counts(spark, root) == before == {"2024-01-04": 1}
    from ledgerlens.sinks.writers import folder_exists
    assert not folder_exists(spark, f"{root}/untouched")


def test_only_bad_rows_leave_an_empty_silver(spark):
    root, bronze = scratch_path(spark, "bad"), scratch_path(spark, "bad-bronze")
    land(spark, bronze, {4: [line("a", 4, status="LOST")]})
    out = bronze_to_silver(spark, bronze, root, "2024-01-04", as_of=as_of())
    assert out["days"] == [] and read_sink(spark, root, "silver").count() == 0
    assert read_sink(spark, root, "quarantine").count() == 1


def test_bronze_overwrite_replaces_all_days(spark):
    root = scratch_path(spark, "all-days")
    land(spark, root, {4: ["x"], 5: ["y"]})
    land(spark, root, {5: ["z"]})
    assert [r.value for r in spark.read.text(root).collect()] == ["z"]


def test_table_ddl_is_of_one_format():
    for logical in ("silver", "quarantine", "audit", "geo"):
        text = catalog.create_table_sql(f"db.{logical}", logical, "/lake", "iceberg")
        assert "USING iceberg" in text and "parquet'" in text
        assert ("PARTITIONED BY (days(ds))" if logical == "geo" else "PARTITIONED BY (ds_day)") in text
        plain = catalog.create_table_sql(f"db.{logical}", logical, "/lake")
        assert "USING parquet" in plain and "days(" not in plain


def test_local_folders_only_for_a_local_master():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError):
        checkpoint_root(Session())


def test_landing_day_of_spaced_and_compact_lines(spark):
    from ledgerlens.streaming.jobs import line_day
    lines = ['{"event_ts":"2024-01-05T10:00:00Z"}', '{"event_id": "a", "event_ts": "2024-01-06T10:00:00Z"}',
             '{"event_ts": "bad", "event_time": "2024-01-07T00:00:00Z"}', '{"event_ts": "2024-01-08"}{"event_ts": "2024-01-09"}',
             "junk", '{"note": "\\"event_ts\\": \\"2024-01-01\\""}']
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = [str(r[0]) for r in df.select(line_day(F.col("value"), F.lit(dt.date(2024, 2, 1)))).collect()]
    assert got == ["2024-01-05", "2024-01-06", "2024-01-07", "2024-01-08", "2024-02-01", "2024-02-01"]


def test_epoch_numbers_end_with_year_9999(spark):
    from ledgerlens.functions import parse_event_ts
    texts = ["1704067200", "1704067200123", "253402300799", "253402300800", "999999999999", "253402300799999",
             "253402300800000", "99999999999999999999"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    years = [r[0] for r in df.select(F.year(parse_event_ts(F.col("t")))).collect()]
    assert years == [2024, 2024, 9999, None, None, 9999, None, None]


def test_streamed_copies_of_a_hot_key_meet_once(spark):
    from ledgerlens.streaming.jobs import dedup_stream_batched, dedup_stream
    src = scratch_path(spark, "hot-src")
    rows = spark.range(400).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('k', id) END AS event_id",
                                       "timestamp_seconds(1704067200 + id) AS event_ts").repartition(7)
    rows.write.parquet(src)
    for job in ("state", "store"):
        out, ckpt = scratch_path(spark, "hot-out"), scratch_path(spark, "hot-ckpt")
        if job == "state":
            dedup_stream(spark, src, rows.schema, out, ckpt, max_files_per_trigger=10)
        else:
            dedup_stream_batched(spark, src, rows.schema, out, scratch_path(spark, "hot-seen"), ckpt, max_files_per_trigger=2)
        got = spark.read.parquet(out).groupBy("event_id").count().collect()
        by_id = {r.event_id: r["count"] for r in got}
        assert by_id.pop(None) == 133 and set(by_id.values()) == {1} and len(by_id) == 1 + 133
