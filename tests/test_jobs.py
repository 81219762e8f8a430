"""Writers, tables, rerun safety, batch = stream."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import quality
from ledgerlens.plans import gold as gold_jobs
from ledgerlens.plans.silver import bronze_to_silver, to_silver
from ledgerlens.session import scratch_path
from ledgerlens.sinks import catalog
from ledgerlens.sinks.writers import append_table, replace_table_property, write_partitioned
from ledgerlens.sources import bronze as B
from ledgerlens.sources import tables
from ledgerlens.sources.fixtures import bronze_lines, payment_events
from ledgerlens.streaming import jobs as stream_jobs

SF = "/root/testdata/sf0.001"


def _as_of():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


@pytest.fixture(scope="module")
def bronze_root(spark):
    root = scratch_path(spark, "bronze-test")
    B.write_bronze(bronze_lines(spark.read.parquet(f"{SF}/events.parquet")), root, mode="overwrite")
    return root


def _snapshot(df):
    return sorted(tuple(r) for r in df.collect())


def test_bronze_to_silver_rerun_is_idempotent(spark, bronze_root):
    out = scratch_path(spark, "lake")
    bronze_to_silver(spark, bronze_root, out, "2024-01-05", as_of=_as_of())
    first = _snapshot(spark.read.parquet(f"{out}/silver").select("transaction_id", "ds_day"))
    bronze_to_silver(spark, bronze_root, out, "2024-01-05", as_of=_as_of())
    assert _snapshot(spark.read.parquet(f"{out}/silver").select("transaction_id", "ds_day")) == first
    # another bronze day lands beside it without touching the first
    bronze_to_silver(spark, bronze_root, out, "2024-01-06", as_of=_as_of())
    s = spark.read.parquet(f"{out}/silver")
    assert s.where(F.col("bronze_day") == F.lit("2024-01-05").cast("date")).count() == len(first)
    assert s.select("bronze_day").distinct().count() == 2
    audit = spark.read.parquet(f"{out}/audit").agg(F.sum("records")).first()[0]
    q = spark.read.parquet(f"{out}/quarantine").count()
    assert audit == s.count() + q


def test_gold_rerun_is_idempotent(spark, bronze_root):
    out = scratch_path(spark, "lake")
    bronze_to_silver(spark, bronze_root, out, None, as_of=_as_of())
    days = gold_jobs.touched_days(spark.read.parquet(f"{out}/silver"))
    gold_jobs.silver_to_gold(spark, f"{out}/silver", f"{out}/gold", days)
    first = _snapshot(spark.read.parquet(f"{out}/gold/kpis_daily"))
    gold_jobs.silver_to_gold(spark, f"{out}/silver", f"{out}/gold", days[-3:])
    assert _snapshot(spark.read.parquet(f"{out}/gold/kpis_daily")) == first


def test_scan_day_prunes_partitions(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    silver = to_silver(quality.good_rows(quality.validate(payment_events(ev), as_of=_as_of())))
    path = scratch_path(spark, "silver")
    write_partitioned(silver, path, ["ds_day"])
    df = tables.scan_day(spark, path, "2024-01-07")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds_day" in plan
    assert df.select("ds_day").distinct().count() == 1


def test_tables_append_properties_latest_day(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    silver = to_silver(quality.good_rows(quality.validate(payment_events(ev), as_of=_as_of())))
    root = scratch_path(spark, "tables")
    spark.sql("CREATE DATABASE IF NOT EXISTS ledgerlens_test")
    names = catalog.ensure_tables(spark, "ledgerlens_test", root, suffix="_t1")
    catalog.ensure_tables(spark, "ledgerlens_test", root, suffix="_t1")  # idempotent DDL
    with pytest.raises(ValueError):
        tables.require_latest_day(spark, names["silver"])
    replace_table_property(spark, names["silver"], ["write.object-storage.path"], {"write.data.path": "x"})
    props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {names['silver']}").collect()}
    assert props.get("write.data.path") == "x"
    s = silver.withColumn("bronze_day", F.col("ds_day"))
    for c in ("region", "city", "device_id"):
        s = s.withColumn(c, F.col(c))
    append_table(s, names["silver"])
    assert spark.table(names["silver"]).count() == silver.count()
    assert str(tables.require_latest_day(spark, names["silver"])) == str(silver.agg(F.max("ds_day")).first()[0])


def test_stream_validate_equals_batch(spark, bronze_root):
    out, ckpt = scratch_path(spark, "stream"), scratch_path(spark, "ckpt")
    stream_jobs.validate_stream(spark, bronze_root, out, ckpt, as_of=_as_of())
    batch = scratch_path(spark, "batch")
    bronze_to_silver(spark, bronze_root, batch, None, as_of=_as_of())
    cols = ["transaction_id", "event_id", "ds_day", "dq_status", "amount"]
    assert _snapshot(spark.read.parquet(f"{out}/silver").select(*cols)) == \
        _snapshot(spark.read.parquet(f"{batch}/silver").select(*cols))
    # replaying with the same checkpoint processes nothing new
    stream_jobs.validate_stream(spark, bronze_root, out, ckpt, as_of=_as_of())
    assert spark.read.parquet(f"{out}/silver").count() == spark.read.parquet(f"{batch}/silver").count()


def test_geo_job_covers_every_deduplicated_event(spark, bronze_root):
    from ledgerlens.sources.dimensions import address_ranges
    out = scratch_path(spark, "lake")
    bronze_to_silver(spark, bronze_root, out, None, as_of=_as_of())
    days = gold_jobs.touched_days(spark.read.parquet(f"{out}/silver"))
    geo = gold_jobs.geo_to_gold(spark, f"{out}/silver", address_ranges(spark), f"{out}/geo", days, keep_unknown=True)
    total = spark.read.parquet(geo).agg(F.sum("events_total")).first()[0]
    assert total == gold_jobs.silver_days(spark, f"{out}/silver", days).count()
    # rerun for a subset of days leaves the mart unchanged
    before = _snapshot(spark.read.parquet(geo))
    gold_jobs.geo_to_gold(spark, f"{out}/silver", address_ranges(spark), geo, days[:2], keep_unknown=True)
    assert _snapshot(spark.read.parquet(geo)) == before


def test_stream_dedup_counts_late_rows(spark):
    import datetime as dt
    src = scratch_path(spark, "dedup-src")
    schema = "event_id string, event_ts timestamp"
    t0 = dt.datetime(2024, 1, 10, 12, 0, 0)
    first = [("a", t0), ("a", t0), ("b", t0), (None, t0), (None, t0)]
    spark.createDataFrame(first, schema).write.mode("append").parquet(src)
    out, ckpt = scratch_path(spark, "dedup-out"), scratch_path(spark, "dedup-ckpt")
    st = spark.read.parquet(src).schema
    q = stream_jobs.dedup_stream(spark, src, st, out, ckpt, delay="1 hour")
    ids = sorted((r.event_id or "") for r in spark.read.parquet(out).collect())
    assert ids == ["", "", "a", "b"]
    # a later batch pushes the watermark; a row far older than it is late
    spark.createDataFrame([("c", t0 + dt.timedelta(days=1))], schema).write.mode("append").parquet(src)
    stream_jobs.dedup_stream(spark, src, st, out, ckpt, delay="1 hour")
    spark.createDataFrame([("d", t0 - dt.timedelta(days=3))], schema).write.mode("append").parquet(src)
    q = stream_jobs.dedup_stream(spark, src, st, out, ckpt, delay="1 hour")
    assert stream_jobs.rows_dropped_by_watermark(q) >= 1
    assert "d" not in {r.event_id for r in spark.read.parquet(out).collect()}


def test_batched_stream_dedup_first_copy_and_replay(spark):
    import datetime as dt
    schema = "event_id string, event_ts timestamp, v string"
    src = scratch_path(spark, "bd-src")
    t0 = dt.datetime(2024, 1, 10, 12, 0, 0)
    hot = [("hot", t0 + dt.timedelta(seconds=i), f"h{i}") for i in range(300)]
    spark.createDataFrame(hot + [("b", t0, "b0"), (None, t0, "n0"), (None, t0, "n1")], schema) \
        .write.mode("append").parquet(src)
    out, seen, ckpt = scratch_path(spark, "bd-out"), scratch_path(spark, "bd-seen"), scratch_path(spark, "bd-ckpt")
    st = spark.read.parquet(src).schema
    stream_jobs.dedup_stream_batched(spark, src, st, out, seen, ckpt)
    rows = {(r.event_id, r.v) for r in spark.read.parquet(out).collect()}
    assert rows == {("hot", "h0"), ("b", "b0"), (None, "n0"), (None, "n1")}
    # a later batch repeats ids already emitted: nothing new except 'c'
    spark.createDataFrame([("hot", t0, "again"), ("b", t0, "again"), ("c", t0, "c0")], schema) \
        .write.mode("append").parquet(src)
    stream_jobs.dedup_stream_batched(spark, src, st, out, seen, ckpt)
    rows = {(r.event_id, r.v) for r in spark.read.parquet(out).collect()}
    assert rows == {("hot", "h0"), ("b", "b0"), (None, "n0"), (None, "n1"), ("c", "c0")}


@pytest.mark.parametrize("delay", [None, 0, 1])
def test_batched_dedup_does_not_depend_on_the_batches(spark, delay):
    """Plain rule, whatever number of files a micro-batch takes."""
    import datetime as dt
    import random

    rng = random.Random(3)
    day = dt.datetime(2024, 1, 1)
    rows = sorted((day + dt.timedelta(days=rng.randrange(6), hours=rng.randrange(24), seconds=i), f"k{rng.randrange(6)}", i)
                  for i in range(60))
    kept = {}
    for t, k, i in rows:
        if not any(delay is None or abs((t.date() - o.date()).days) <= delay for o, _ in kept.get(k, [])):
            kept.setdefault(k, []).append((t, i))
    want = sorted(i for v in kept.values() for _, i in v)
    src = scratch_path(spark, "any-src")
    schema = "event_id string, event_ts timestamp, v int"
    for d in range(6):
        part = [(k, t, i) for t, k, i in rows if t.date() == (day + dt.timedelta(days=d)).date()]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
    for files in (2, 100):
        out, seen, ckpt = (scratch_path(spark, f"any-{n}") for n in ("out", "seen", "ckpt"))
        stream_jobs.dedup_stream_batched(spark, src, spark.read.parquet(src).schema, out, seen, ckpt,
                                         delay_days=delay, max_files_per_trigger=files)
        assert sorted(r["v"] for r in spark.read.parquet(out).collect()) == want


def test_catalog_partition_overwrite_is_idempotent(spark):
    from ledgerlens.sinks.writers import overwrite_table_partitions
    spark.sql("CREATE DATABASE IF NOT EXISTS ledgerlens_test")
    root = scratch_path(spark, "tbl")
    name = "ledgerlens_test.daily_counts_t2"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (n bigint, ds_day date) USING parquet "
              f"PARTITIONED BY (ds_day) LOCATION '{root}'")
    d1 = spark.createDataFrame([(5, "2024-01-01"), (7, "2024-01-02")], "n bigint, ds string") \
        .selectExpr("n", "CAST(ds AS DATE) AS ds_day")
    overwrite_table_partitions(d1, name)
    overwrite_table_partitions(d1, name)  # rerun: no doubling
    d2 = spark.createDataFrame([(9, "2024-01-02")], "n bigint, ds string").selectExpr("n", "CAST(ds AS DATE) AS ds_day")
    overwrite_table_partitions(d2, name)  # replaces only 2024-01-02
    got = sorted((str(r.ds_day), r.n) for r in spark.table(name).collect())
    assert got == [("2024-01-01", 5), ("2024-01-02", 9)]


def test_mart_writes_one_file_per_day(spark):
    """Marts grouped by (day, key) are rebalanced on the day before the write,
    so reducers do not each leave a small file in every day."""
    import glob

    silver = scratch_path(spark, "silver_files")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    s = to_silver(quality.good_rows(quality.validate(payment_events(ev), as_of=_as_of())))
    write_partitioned(s, silver, ["ds_day"])
    days = gold_jobs.touched_days(spark.read.parquet(silver))
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = gold_jobs.silver_to_gold(spark, silver, scratch_path(spark, "gold_files"), days)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)
    for name in ("by_merchant", "hourly"):
        per_day = [len(glob.glob(f"{p}/*.parquet")) for p in glob.glob(f"{out[name].removeprefix('file:')}/ds_day=*")]
        assert len(per_day) == len(days) and max(per_day) == 1
