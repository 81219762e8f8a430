"""Landing ledger, schema registry, line samples, card sketches, views by name."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators import gold
from ledgerlens.plans import silver as S
from ledgerlens.plans import views
from ledgerlens.session import scratch_path
from ledgerlens.sinks.manifest import read_manifest
from ledgerlens.sinks.writers import _hadoop_path
from ledgerlens.sources import bronze as B
from ledgerlens.sources import schemas

from test_reruns import as_of, ids, line


def land_file(spark, root, day, values, mode="append"):
    df = spark.createDataFrame([(v, "2024", "01", f"{day:02d}") for v in values], "value string, year string, month string, day string")
    B.write_bronze(df.coalesce(1), root, mode)


def test_only_days_with_new_changed_or_vanished_files_are_run(spark, monkeypatch):
    root, out = scratch_path(spark, "ledger-bronze"), scratch_path(spark, "ledger")
    read = []
    real = S.read_bronze
    monkeypatch.setattr(S, "read_bronze", lambda *a, **kw: read.append(kw["day"]) or real(*a, **kw))

    def run():
        return S.landed_to_silver(spark, root, out, as_of=as_of())["bronze_days"]

    land_file(spark, root, 4, [line("a", 4)])
    land_file(spark, root, 5, [line("b", 5), line("bad", 5, status="LOST")])
    assert run() == ["2024-01-04", "2024-01-05"]
    assert run() == [] and len(read) == 1            # an unchanged tree: no line is read
    land_file(spark, root, 4, [line("c", 4)])         # a further file in an old day
    assert run() == ["2024-01-04"] == read[-1]
    assert ids(spark, out, "silver") == [("t-a", "2024-01-04"), ("t-b", "2024-01-05"), ("t-c", "2024-01-04")]
    fs, p = _hadoop_path(spark, f"{root}/year=2024/month=01/day=05")
    fs.delete(p, True)                                # a day that should not have been there
    assert run() == ["2024-01-05"]
    assert ids(spark, out, "silver") == [("t-a", "2024-01-04"), ("t-c", "2024-01-04")]
    assert ids(spark, out, "quarantine") == []
    # a run that dies does not count as having read its files
    land_file(spark, root, 6, [line("d", 6)])
    with monkeypatch.context() as m:
        m.setattr(S, "write_copies", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run()
    assert run() == ["2024-01-06"] and run() == []
    assert set(read_manifest(spark, out).batches) == {"2024-01-04", "2024-01-06"}


def struct(text):
    return T._parse_datatype_string(text)


def test_types_meet_in_a_lattice(spark):
    cases = [("bigint", "int", "bigint"), ("bigint", "decimal(4,1)", "double"), ("double", "string", "string"),
             ("boolean", "bigint", "string"), ("struct<a:bigint>", "struct<a:double,b:string>", "struct<a:double,b:string>"),
             ("array<bigint>", "array<double>", "array<double>"), ("struct<a:bigint>", "array<bigint>", "string"),
             ("void", "bigint", "bigint"), ("struct<a:bigint>", "string", "string"), ("date", "date", "date")]
    for a, b, out in cases:
        a, b = (T._parse_datatype_string(x) if x != "void" else T.NullType() for x in (a, b))
        assert schemas.widen(a, b).simpleString() == out and schemas.widen(b, a).simpleString() in (out, "struct<a:double,b:string>")
    kinds = [T._parse_datatype_string(x) for x in ("bigint", "double", "string", "boolean", "struct<a:bigint>", "struct<a:string>",
                                                   "array<bigint>", "array<string>")]
    for a in kinds:
        assert schemas.widen(a, a) == schemas.settled(a)
        for b in kinds:
            for c in kinds:  # the order of runs does not matter
                assert schemas.widen(schemas.widen(a, b), c) == schemas.widen(a, schemas.widen(b, c))


def test_registry_versions(spark):
    root = scratch_path(spark, "registry")
    assert schemas.registered_schema(spark, root).fields == []
    assert schemas.register_schema(spark, root, struct("a bigint, _corrupt_record string"))[0] == 1
    assert schemas.register_schema(spark, root, struct("a bigint"))[0] == 1      # nothing new
    version, merged = schemas.register_schema(spark, root, struct("b string, a double"))
    assert version == 2 and merged.simpleString() == "struct<a:double,b:string>"
    assert schemas.register_schema(spark, root, struct("b string"))[1] == merged  # nothing is dropped
    assert schemas.registered_schema(spark, root, 1).simpleString() == "struct<a:bigint>"
    assert schemas.schema_history(spark, root).count() == 3
    # the merged schema reads lines of every run
    lines = spark.createDataFrame([('{"a":1}',), ('{"a":1.5,"b":"x"}',)], "raw_line string")
    full = T.StructType([*merged.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = B.parse_events(lines, schema=full).select("a", "b", "is_malformed_json").collect()
    assert sorted(map(tuple, rows)) == [(1.0, None, False), (1.5, "x", False)]


def test_line_samples_do_not_depend_on_partitions_and_merge(spark):
    rows = [(d, f'{{"n":{i},"x":{"null" if i % 3 else 1}}}') for d in range(3) for i in range(200 if d else 7)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows + rows[:50], "day int, raw_line string")
    whole = sorted(map(tuple, B.sample_lines(df, 10, ["day"]).collect()))
    for n in (1, 5, 13):
        assert sorted(map(tuple, B.sample_lines(df.repartition(n), 10, ["day"]).collect())) == whole
    halves = [B.sample_lines(df.where(F.crc32("raw_line") % 2 == k), 10, ["day"]) for k in (0, 1)]
    assert sorted(map(tuple, B.sample_lines(halves[0].union(halves[1]), 10, ["day"]).collect())) == whole
    held = {d: sum(r[0] == d for r in rows + rows[:50]) for d in range(3)}
    assert len(whole) == sum(min(10, n) for n in held.values())
    plan = B.sample_lines(df, 10, ["day"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # a task forwards at most k lines a group
    profile = {(r.day, r.field): (r.objects, r.filled) for r in B.profile_lines(B.sample_lines(df, 1000, ["day"]), ["day"]).collect()}
    assert profile[1, "n"][0] == profile[1, "n"][1] > profile[1, "x"][1] > 0
    assert B.profile_lines(df.limit(0), ["day"]).count() == 0


def test_card_sketches_of_days_give_months(spark):
    base = spark.range(60_000).select(
        F.expr("date_add(DATE'2024-01-01', CAST(id % 60 AS INT))").alias("ds_day"),
        F.concat(F.lit("c"), (F.col("id") * 7919) % 20_000).alias("card_id"))
    path = scratch_path(spark, "sketches")
    gold.cards_daily(base).write.parquet(path)
    daily = spark.read.parquet(path)
    exact = {r[0]: r[1] for r in base.groupBy("ds_day").agg(F.count_distinct("card_id")).collect()}
    assert {r.ds_day: r.distinct_cards for r in daily.collect()} == exact
    for period in ("week", "month", "year"):
        truth = {r[0]: r[1] for r in base.groupBy(F.to_date(F.date_trunc(period, "ds_day"))).agg(F.count_distinct("card_id")).collect()}
        for r in gold.cards_over(daily, period).collect():
            assert abs(r.distinct_cards - truth[r.period_start]) <= 0.05 * truth[r.period_start]
    # days cannot simply be added up
    assert sum(exact.values()) > 1.5 * gold.cards_over(daily, "year").first().distinct_cards


def test_views_by_name_take_a_date(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS ledgerlens_views")
    geo = spark.createDataFrame([("Brazil", "BR", 3, 3, 2, 1, 10.0, 0.5, 1, "2024-01-01"), ("Nowhere", "UNK", 1, 1, 1, 0, 1.0, 0.1, 0, "2024-01-01"),
                                 ("Brazil", "BR", 5, 5, 4, 1, 20.0, 0.2, 1, "2023-09-01")],
                                "country_name string, country_iso2 string, events_total long, transactions_total long, approved_total long, "
                                "declined_total long, amount_sum double, risk_score_avg double, international_total long, d string")
    geo = geo.withColumn("ds", F.col("d").cast("date")).drop("d")
    daily = spark.createDataFrame([("2024-01-01", 4, 0, 3, 1, 11.0, 2.75, 0.4, 1)],
                                  "ds_day string, events_total long, transactions_total long, approved_total long, declined_total long, "
                                  "amount_sum double, amount_avg double, risk_score_avg double, international_total long")
    for name, df in (("geo_t", geo), ("daily_t", daily)):
        df.write.mode("overwrite").option("path", scratch_path(spark, name)).saveAsTable(f"ledgerlens_views.{name}")
    views.create_view_functions(spark, "ledgerlens_views.geo_t", "ledgerlens_views.daily_t", "ledgerlens_views")
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase("ledgerlens_views")
    try:
        import datetime as dt
        for day, n in (("2024-01-31", 2), ("2023-10-01", 3), ("2025-01-01", 0)):
            got = spark.sql(f"SELECT * FROM v_geo_daily_90d(DATE'{day}')")
            same = views.v_geo_daily(geo, dt.date.fromisoformat(day))
            assert got.columns == same.columns
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, same.collect())) and got.count() == n
            got = spark.sql(f"SELECT * FROM v_geo_dashboard_latlon_90d(as_of => DATE'{day}')")
            same = views.v_geo_dashboard_latlon(spark, geo, dt.date.fromisoformat(day))
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, same.collect()))
        r = spark.sql("SELECT * FROM v_fraud_kpis_daily").first()
        assert r.decline_rate_pct is None and r.international_rate_pct is None  # no transactions: no rate
        assert spark.table("v_gold_fraud_dashboard").first().approval_rate is None
    finally:
        spark.catalog.setCurrentDatabase(before)
