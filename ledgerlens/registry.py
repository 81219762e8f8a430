"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator, each reading the driver tables (or data Spark derives from them)
in full, plus the matching DuckDB oracle SQL (``oracle.py``).

Outputs are made engine-comparable by ``_finish``: doubles rounded to 6
places, timestamps as zone-free values, arrays joined by commas.  Means of
cent amounts often sit exactly on a tie at the 7th decimal (1361.89 / 32 =
42.5590625) and engines break such ties differently (decimal text versus
binary value), so values are moved off the tie by ``TIE_NUDGE`` first; the
oracle SQL does the same.  Queries
that exercise writers put their files under the session's shared
``spark.checkpoint.dir`` (a fresh folder per run).
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import (boolish_to_int, clean_amount, country_iso2, country_name, day_parts, event_ts_fallback,
                        ingest_ts, is_international, merchant_struct, parse_event_ts)
from .operators import gold, quality
from .operators.dedup import dedup_latest
from .operators.geo import geo_daily, geo_enrich
from .plans import gold as gold_jobs
from .plans import views
from .plans.silver import bronze_to_silver, landed_to_silver, read_sink, stage_batch, to_silver, validate_bronze
from .session import TASKS_PER_CORE, lake_session, scratch_path
from .sinks import catalog
from .sinks.manifest import INDEX_BUCKETS
from .sinks.writers import (append_table, clear_folder, folder_bytes, replace_table_property, snapshot_table,
                            write_partitioned)
from .sources import bronze as B
from .sources import schemas, tables
from .sources.dimensions import address_ranges
from .sources.fixtures import (bronze_lines, copied_lines, faulty_lines, payment_events, untidy_text,
                               with_undeclared_fields)
from .streaming import jobs as stream_jobs

# Fixed evaluation time for time-relative rules (all fixture events are
# earlier), instead of the wall clock, so results are reproducible.
AS_OF = "2024-01-31 00:00:00"
AS_OF_DAY = dt.date(2024, 1, 31)
DB = "ledgerlens_q"
LINE_PART_BYTES = 1 << 20


def as_of():
    return F.lit(AS_OF).cast("timestamp")


# ---------------------------------------------------------------- helpers --

TIE_NUDGE = 1e-9


def _finish(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c + F.lit(TIE_NUDGE), 6)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    lake_session(spark)
    # the small input files are one row group each: who runs the queries may say
    # over how many partitions to deal them
    partitions = spark.conf.get("spark.ledgerlens.inputPartitions", None)
    return tables.spread(spark.read.parquet(f"{sf}/events.parquet"), int(partitions) if partitions else None)


def _payments(spark, sf):
    return payment_events(_events(spark, sf))


def _untidy(spark, sf):
    return untidy_text(_events(spark, sf))


def _validated(spark, sf):
    return quality.validate(_payments(spark, sf), as_of=as_of())


def _silver(spark, sf):
    return to_silver(quality.good_rows(_validated(spark, sf)))


def _base(spark, sf):
    return gold.gold_base(_silver(spark, sf))


def _geo(spark, sf, keep_unknown=True):
    return geo_daily(geo_enrich(_silver(spark, sf), address_ranges(spark)), keep_unknown)


def _dealt_events(spark, sf):
    """``events`` over a partition for each MB of it, up to ``TASKS_PER_CORE`` for
    each core: a row group is read by one task, and making lines of it is work."""
    most = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    parts = min(most, -(-folder_bytes(spark, f"{sf}/events.parquet") // LINE_PART_BYTES))
    events = _events(spark, sf).select("event_id", "ts", "user_id", "event_type", "value")
    return events.repartition(parts) if parts > 1 else events


def _bronze_root(spark, sf) -> str:
    """Bronze lines derived from ``events`` landed as gzip text partitions."""
    root = scratch_path(spark, "bronze")
    B.write_bronze(bronze_lines(_dealt_events(spark, sf)), root, mode="overwrite")
    return root


def _stored_lines(spark, sf):
    """The bronze lines as a table: tests on a line would otherwise repeat the
    expressions that make it."""
    path = scratch_path(spark, "lines")
    bronze_lines(_dealt_events(spark, sf)).write.parquet(path)
    return spark.read.parquet(path)


def _fragments(spark, sf):
    lines = bronze_lines(_events(spark, sf)).select(F.col("value").alias("raw_line"))
    return B.unglue(lines)


def _silver_written(spark, sf, partition_cols=("ds_day",)) -> str:
    path = scratch_path(spark, "silver")
    write_partitioned(_silver(spark, sf), path, list(partition_cols))
    return path


def _medallion_silver(spark, sf) -> str:
    """bronze text -> silver/quarantine/audit (whole tree, rerun-safe)."""
    out = scratch_path(spark, "lake")
    bronze_to_silver(spark, _bronze_root(spark, sf), out, None, as_of=as_of())
    return out


def _table_name(stem: str) -> str:
    return f"{DB}.{stem}_{uuid.uuid4().hex[:10]}"


def _ensure_db(spark):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DB}")


# ------------------------------------------------------------ gold marts --

def q_kpis_daily(spark, sf):
    return _finish(gold.kpis_daily(_base(spark, sf)))


def q_by_region(spark, sf):
    return _finish(gold.by_region(_base(spark, sf)))


def q_by_channel(spark, sf):
    return _finish(gold.by_channel(_base(spark, sf)))


def q_by_merchant(spark, sf):
    return _finish(gold.by_merchant(_base(spark, sf)))


def q_top_merchants(spark, sf):
    return _finish(gold.top_merchants(_base(spark, sf), 20))


def q_hourly(spark, sf):
    return _finish(gold.hourly(_base(spark, sf)))


def q_by_decline_reason(spark, sf):
    return _finish(gold.by_decline_reason(_base(spark, sf)))


def q_by_payment_method(spark, sf):
    return _finish(gold.by_payment_method(_base(spark, sf)))


def q_gold_events_daily(spark, sf):
    return _finish(gold.events_daily_wide(_base(spark, sf)))


def q_cards_by_period(spark, sf):
    path = scratch_path(spark, "cards")
    write_partitioned(gold.cards_daily(_base(spark, sf)), path, ["ds_day"], rebalance=True)
    daily = spark.read.parquet(path)
    periods = [daily.select(F.lit("day").alias("period"), F.col("ds_day").alias("period_start"), "distinct_cards")]
    periods += [gold.cards_over(daily, p).select(F.lit(p).alias("period"), "period_start", "distinct_cards")
                for p in ("week", "month")]
    return periods[0].unionByName(periods[1]).unionByName(periods[2])


def q_kpis_by_event_date(spark, sf):
    return _finish(gold.kpis_by_event_date(_base(spark, sf)))


def q_v_daily_by_type(spark, sf):
    return _finish(gold.daily_by_type(_base(spark, sf)))


def q_events_count(spark, sf):
    return gold.events_count(_silver(spark, sf))


def q_status_normalize(spark, sf):
    return _base(spark, sf).select("transaction_id", "approved_norm", "is_approved", "is_declined", "status")


def q_safe_col_coalesce(spark, sf):
    b = gold.gold_base(_payments(spark, sf))
    return _finish(b.select("transaction_id", "approved_norm", "status", "amount_num", "risk_score_num",
                            "is_international_num", "channel", "decline_reason", "merchant_id_norm",
                            "merchant_mcc", "merchant_country", "merchant_city"))


def q_partition_columns(spark, sf):
    parts = day_parts(F.col("ds_day"))
    return (_silver(spark, sf).groupBy(*[c.alias(f"event_{n}") for n, c in parts.items()])
            .agg(F.count(F.lit(1)).alias("events")))


def q_risk_buckets(spark, sf):
    return _silver(spark, sf).groupBy("ds_day", "risk_bucket").agg(F.count(F.lit(1)).alias("events"))


def q_dedup_event_id(spark, sf):
    narrow = _silver(spark, sf).select("event_id", "event_ts", "transaction_id")
    return dedup_latest(narrow, "event_id", ["event_ts", "transaction_id"]).select("event_id", "transaction_id")


# ------------------------------------------------------- column functions --

def q_parse_event_ts(spark, sf):
    u = _untidy(spark, sf)
    return _finish(u.select("event_id", "time_text", parse_event_ts(F.col("time_text")).alias("event_ts")))


def q_drop_null_event_ts(spark, sf):
    u = _untidy(spark, sf).select("event_id", parse_event_ts(F.col("time_text")).alias("event_ts"))
    return _finish(u.where(F.col("event_ts").isNotNull()))


def q_ingest_ts(spark, sf):
    ev = _events(spark, sf)
    a = _untidy(spark, sf).select("event_id", F.col("time_text").alias("ingest_time"))
    b = ev.select("event_id", F.col("ts").alias("ingest_timestamp"))
    ra = a.select("event_id", F.lit("ingest_time").alias("variant"), ingest_ts(a).alias("ingest_ts"))
    rb = b.select("event_id", F.lit("ingest_timestamp").alias("variant"), ingest_ts(b).alias("ingest_ts"))
    return _finish(ra.unionByName(rb))


def q_event_ts_fallback(spark, sf):
    df = untidy_text(_events(spark, sf), keep=("ts",)).select(
        "event_id", F.col("time_text").alias("event_ts"),
        F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("event_time"),
        F.col("ts").alias("ingest_ts"))
    return _finish(df.select("event_id", event_ts_fallback(df).alias("event_ts")))


def q_clean_amount(spark, sf):
    u = _untidy(spark, sf)
    return _finish(u.select("event_id", "amount_text", clean_amount(F.col("amount_text")).alias("amount"),
                            clean_amount(F.col("amount_text"), strict=True).alias("amount_strict")))


def _country_frame(spark, sf):
    u = _untidy(spark, sf)
    return u.select("event_id", F.col("country_a").alias("country"), F.col("country_b").alias("country_code"))


def q_country_iso2(spark, sf):
    df = _country_frame(spark, sf)
    return df.select("event_id", country_iso2(df).alias("country_iso2"),
                     country_iso2(df, strict=True).alias("country_iso2_strict"))


def q_country_name(spark, sf):
    df = _country_frame(spark, sf)
    iso = country_iso2(df)
    return df.select("event_id", iso.alias("country_iso2"), country_name(iso).alias("country_name"))


def q_normalize_codes(spark, sf):
    p = _payments(spark, sf)
    loose, strict = quality.normalized_codes(p), quality.normalized_codes(p, strict=True)
    return p.select("transaction_id", *[c.alias(n) for n, c in loose.items()],
                    *[strict[n].alias(f"{n}_strict") for n in ("country", "channel")])


def q_boolish_to_int(spark, sf):
    u = _untidy(spark, sf)
    return u.select("event_id", "bool_text", boolish_to_int(F.col("bool_text")).alias("flag"))


def q_is_international(spark, sf):
    u = _untidy(spark, sf)
    return u.select("event_id", "bool_text", is_international(F.col("bool_text")).alias("is_international"))


def q_merchant_parse(spark, sf):
    u = _untidy(spark, sf)
    return u.select("event_id", merchant_struct(u).alias("m")).select("event_id", "m.*")


def q_country_surrogate(spark, sf):
    return _finish(views.silver_fraud_events_geo_v(_silver(spark, sf)))


# -------------------------------------------------------------- quality --

def q_dq_errors(spark, sf):
    v = _validated(spark, sf)
    return v.select("transaction_id", F.explode("dq_errors").alias("dq_error"))


def q_dq_status(spark, sf):
    v = _validated(spark, sf)
    return _finish(v.select("transaction_id", "dq_status", "dq_errors", "dq_hard_errors"))


def q_dq_good_rows(spark, sf):
    s = _silver(spark, sf)
    return _finish(s.select("transaction_id", "event_id", "ds_day", "dq_status", "dq_errors", "currency",
                            "country", "channel", "status", "amount", "approved_int",
                            "is_international_int", "country_iso2", "risk_bucket"))


def q_dq_quarantine(spark, sf):
    q = quality.quarantine_view(_validated(spark, sf))
    return _finish(q.select("transaction_id", "event_id", "user_id", "dq_status", "dq_errors",
                            "dq_hard_errors", "ds_day"))


def q_dq_audit(spark, sf):
    return quality.audit(_validated(spark, sf))


def q_dq_error_counts(spark, sf):
    return quality.error_counts(_validated(spark, sf))


def q_pipeline_counters(spark, sf):
    obs = Observation("dq_counters")
    v = _validated(spark, sf).observe(
        obs, F.count(F.lit(1)).alias("rows_total"),
        F.count_if(F.col("dq_status") == "GOOD").alias("rows_good"),
        F.count_if(F.col("dq_status") == "WARN").alias("rows_warn"),
        F.count_if(F.col("dq_status") == "BAD").alias("rows_bad"))
    # the counters ride along the real write: no extra pass over the data
    write_partitioned(to_silver(quality.good_rows(v)), scratch_path(spark, "observed"), ["ds_day"])
    m = obs.get
    schema = "rows_total bigint, rows_good bigint, rows_warn bigint, rows_bad bigint"
    return spark.createDataFrame([(m["rows_total"], m["rows_good"], m["rows_warn"], m["rows_bad"])], schema)


# --------------------------------------------------------------- bronze --

def q_bronze_unglue(spark, sf):
    u = _untidy(spark, sf).select("event_id", "raw_line")
    return B.unglue(u).select("event_id", "fragment_idx", F.col("raw_line").alias("fragment"))


def q_bronze_parse_typed(spark, sf):
    p = B.parse_events(_fragments(spark, sf))
    return _finish(p.select("transaction_id", "event_id", "user_id", "card_id", "merchant_id", "merchant",
                            "amount", "currency", "payment_method", "channel", "country", "ip_address",
                            "risk_score", "is_international", "status", "approved", "decline_reason",
                            "event_type", "event_ts", "event_time", "mcc", "device", "metadata", "country_code",
                            "countryCode", "country_iso", "country_iso2", "is_malformed_json"))


def q_infer_event_schema(spark, sf):
    return B.inferred_fields(B.unglue(_untidy(spark, sf).select("event_id", "raw_line")))


def q_bronze_sample_profile(spark, sf):
    """Fields of 20 lines of each day."""
    u = untidy_text(_events(spark, sf), keep=("ts",)).select(F.to_date("ts").alias("day"), "raw_line")
    return B.profile_lines(B.sample_lines(u, 20, ["day"]), ["day"])


def q_schema_registry(spark, sf):
    """Three bronze days: whole amounts, amounts with a fraction, a new field."""
    u, root = _untidy(spark, sf), scratch_path(spark, "schemas")
    line = {0: F.col("raw_line"), 1: F.regexp_replace("raw_line", '"amount":([0-9]+)', '"amount":$1.5'),
            2: F.regexp_replace("raw_line", r"\}$", ',"channel":"web"}')}
    for k, text in line.items():
        day = B.unglue(u.where(F.col("event_id") % 3 == k).select(text.alias("raw_line")))
        schemas.register_schema(spark, root, B.inferred_struct(day))
    return schemas.schema_history(spark, root)


def q_bronze_scan_day(spark, sf):
    root = _bronze_root(spark, sf)
    day = _events(spark, sf).agg(F.max(F.to_date("ts"))).first()[0]
    raw = B.read_bronze(spark, root, day=str(day), as_of=as_of())
    return raw.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("lines"))


def q_bronze_scan_lineage(spark, sf):
    raw = B.read_bronze(spark, _bronze_root(spark, sf), as_of=as_of())
    return raw.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("lines"), F.count("source_file").alias("lines_with_source"))


# ------------------------------------------------------ tables and sinks --

def q_silver_scan_day(spark, sf):
    path = _silver_written(spark, sf)
    day = tables.require_latest_day(spark, _external_silver_table(spark, path))
    return _finish(tables.scan_day(spark, path, str(day)).select(
        "transaction_id", "event_id", "amount", "channel", "ds_day"))


def q_silver_scan_paths(spark, sf):
    path = _silver_written(spark, sf)
    days = gold_jobs.touched_days(spark.read.parquet(path))
    df = tables.scan_paths(spark, [f"{path}/ds_day={d}" for d in days], base_path=path)
    return _finish(df.groupBy("ds_day").agg(F.count(F.lit(1)).alias("events"), F.sum("amount").alias("amount_sum")))


def _external_silver_table(spark, path) -> str:
    _ensure_db(spark)
    name = _table_name("silver_ext")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields
                    if f.name != "ds_day") + ", ds_day date"
    tables.create_external_table(spark, name, ddl, path, partitioned_by=["ds_day"])
    tables.repair_partitions(spark, name)
    return name


def q_external_table_scan(spark, sf):
    t = spark.table(_external_silver_table(spark, _silver_written(spark, sf)))
    return _finish(t.groupBy("ds_day", "channel").agg(F.count(F.lit(1)).alias("events"),
                                                      F.sum("amount").alias("amount_sum")))


def _flat_external_table(spark, sf, files: int | None) -> DataFrame:
    """An external table without partitions over the files of a daily mart."""
    _ensure_db(spark)
    path, name = scratch_path(spark, "flat"), _table_name("kpis_ext")
    mart = gold.kpis_daily(_base(spark, sf))
    (mart.coalesce(files) if files else mart).write.parquet(path)  # one row a day
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in mart.schema.fields)
    tables.create_external_table(spark, name, ddl, path)
    return spark.table(name)


def q_external_table_unpartitioned(spark, sf):
    return _finish(_flat_external_table(spark, sf, None))


def q_external_table_single_file(spark, sf):
    return _finish(_flat_external_table(spark, sf, 1))


def q_latest_partition_day(spark, sf):
    return tables.latest_partition_day(spark, _external_silver_table(spark, _silver_written(spark, sf)))


def q_table_append_readback(spark, sf):
    _ensure_db(spark)
    root = scratch_path(spark, "tables")
    names = catalog.ensure_tables(spark, DB, root, suffix="_" + uuid.uuid4().hex[:10])
    replace_table_property(spark, names["silver"], unset=["write.object-storage.path"],
                           set_props={"write.data.path": f"{root}/silver/data"})
    append_table(_silver(spark, sf).withColumn("bronze_day", F.col("ds_day")), names["silver"])
    t = spark.table(names["silver"])
    return t.groupBy("ds_day", "dq_status").agg(F.count(F.lit(1)).alias("records"))


def q_silver_write_readback(spark, sf):
    out = _medallion_silver(spark, sf)
    s = read_sink(spark, out, "silver")
    return _finish(s.select("transaction_id", "event_id", "bronze_day", "ds_day", "dq_status", "dq_errors",
                            "amount", "currency", "channel", "country", "country_iso2", "mcc", "device", "metadata",
                            "approved_int", "risk_bucket"))


def q_silver_unknown_fields(spark, sf):
    """Undeclared fields of silver's and the quarantine's records, from the kept VARIANT."""
    root, out = scratch_path(spark, "bronze"), scratch_path(spark, "lake")
    B.write_bronze(with_undeclared_fields(bronze_lines(_dealt_events(spark, sf))), root, mode="overwrite")
    bronze_to_silver(spark, root, out, None, as_of=as_of(), whole_events=True)
    rows = [read_sink(spark, out, s, whole_events=True).select(
        F.lit(s).alias("sink"), B.event_field("$.transaction_id").alias("transaction_id"), "event",
        "ds_day") for s in ("silver", "quarantine")]
    return _finish(rows[0].union(rows[1]).select(
        "sink", "transaction_id", "ds_day", B.event_field("$.loyalty.points", "bigint").alias("points"),
        B.event_field("$.loyalty.tier").alias("tier"), B.event_field("$.coupon").alias("coupon"),
        F.array_join(B.undeclared_fields(), ",").alias("undeclared")))


def _gold_from_medallion(spark, sf, runs: int = 1, parts: int = 1) -> str:
    """Marts of all silver days, ``runs`` times, each in ``parts`` runs."""
    out = _medallion_silver(spark, sf)
    days = gold_jobs.touched_days(read_sink(spark, out, "silver"))
    gold_root = f"{out}/gold"
    for _ in range(runs):
        for k in range(parts):
            gold_jobs.silver_to_gold(spark, f"{out}/silver", gold_root, days[k::parts])
    return gold_root


def _land_again(lines, root: str, days: list) -> None:
    """Make the folders of these days hold what ``lines`` has of them; the lines of
    the other days lie there as they are."""
    for d in days:
        clear_folder(lines.sparkSession, f"{root}/year={d:%Y}/month={d:%m}/day={d:%d}")
    arrived = F.make_date(*[F.col(c).cast("int") for c in ("year", "month", "day")])
    B.write_bronze(lines.where(arrived.isin([F.lit(str(d)).cast("date") for d in days])), root)


def _corrected_lake(spark, sf, marts: bool = False) -> str:
    """A lake whose first days arrived with faults and were run, then arrived
    corrected and were run again, day by day; a day that should never have
    been there is empty after the correction."""
    lines = _stored_lines(spark, sf)
    first = _events(spark, sf).agg(F.min(F.to_date("ts"))).first()[0]
    root, out = scratch_path(spark, "bronze"), scratch_path(spark, "lake")
    B.write_bronze(faulty_lines(lines, first), root, mode="overwrite")
    bronze_to_silver(spark, root, out, None, as_of=as_of())
    if marts:
        gold_jobs.silver_to_gold(spark, f"{out}/silver", f"{out}/gold", gold_jobs.ALL_DAYS)
    days = [first + dt.timedelta(days=k) for k in (-1, 0, 1)]
    _land_again(lines, root, days)
    for day in days:
        run = bronze_to_silver(spark, root, out, str(day), as_of=as_of())
        if marts:
            gold_jobs.silver_to_gold(spark, f"{out}/silver", f"{out}/gold", run["days"])
    return out


def q_silver_incremental_landing(spark, sf):
    """Files land in two parts, the second with further files in days that were
    run already; a third run finds nothing to do."""
    lines = _stored_lines(spark, sf)
    root, out = scratch_path(spark, "bronze"), scratch_path(spark, "lake")
    late = (F.col("day").cast("int") > 10) | (F.crc32("value") % 40 == 0) & (F.col("day").cast("int") < 4)
    for part in (lines.where(~late), lines.where(late)):
        B.write_bronze(part, root)
        landed_to_silver(spark, root, out, as_of=as_of())
    again = landed_to_silver(spark, root, out, as_of=as_of())
    keys = ["bronze_day", "ds_day", "dq_status"]
    found = read_sink(spark, out, "silver").groupBy(*keys).agg(F.count(F.lit(1)).alias("records"))
    return found.withColumn("days_run_again", F.lit(len(again["bronze_days"])))


def _sink_counts(spark, sf, sink: str):
    df = read_sink(spark, _corrected_lake(spark, sf), sink)
    keys = ["bronze_day", "ds_day", "dq_status"]
    if sink == "audit":
        return df.select(*keys, "records")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("records"))


def q_silver_rerun_corrected(spark, sf):
    return _sink_counts(spark, sf, "silver")


def q_quarantine_rerun_corrected(spark, sf):
    return _sink_counts(spark, sf, "quarantine")


def q_audit_rerun_corrected(spark, sf):
    return _sink_counts(spark, sf, "audit")


def q_gold_rerun_corrected(spark, sf):
    return _finish(spark.read.parquet(f"{_corrected_lake(spark, sf, marts=True)}/gold/kpis_daily"))


def _uncopied_lake(spark, sf, crash: bool) -> str:
    """A lake in which the first day's events had later copies on the next day,
    until that day was corrected and run again; the events count on their own
    day again.  ``crash``: one run of the corrected day dies before its commit,
    and one between silver and the marts."""
    lines = _stored_lines(spark, sf)
    first = _events(spark, sf).agg(F.min(F.to_date("ts"))).first()[0]
    root, out = scratch_path(spark, "bronze"), scratch_path(spark, "lake")
    B.write_bronze(copied_lines(lines, first), root, mode="overwrite")
    bronze_to_silver(spark, root, out, None, as_of=as_of())
    gold_jobs.silver_to_gold(spark, f"{out}/silver", f"{out}/gold", gold_jobs.ALL_DAYS)
    B.write_bronze(lines, root, mode="overwrite")
    corrected = str(first + dt.timedelta(days=1))
    if crash:
        stage_batch(validate_bronze(spark, root, day=corrected, as_of=as_of()), out, corrected, "rdied", INDEX_BUCKETS)
        bronze_to_silver(spark, root, out, corrected, as_of=as_of())
    run = bronze_to_silver(spark, root, out, corrected, as_of=as_of())
    gold_jobs.silver_to_gold(spark, f"{out}/silver", f"{out}/gold", run["days"])
    return out


def q_gold_rerun_removed_copy(spark, sf):
    return _finish(spark.read.parquet(f"{_uncopied_lake(spark, sf, crash=False)}/gold/kpis_daily"))


def q_gold_rerun_after_crash(spark, sf):
    return _finish(spark.read.parquet(f"{_uncopied_lake(spark, sf, crash=True)}/gold/kpis_daily"))


def q_gold_days_separately(spark, sf):
    return _finish(spark.read.parquet(f"{_gold_from_medallion(spark, sf, parts=3)}/kpis_daily"))


def q_gold_write_readback(spark, sf):
    return _finish(spark.read.parquet(f"{_gold_from_medallion(spark, sf)}/kpis_daily"))


def q_gold_rerun_idempotent(spark, sf):
    return _finish(spark.read.parquet(f"{_gold_from_medallion(spark, sf, runs=2)}/kpis_daily"))


def q_kpi_snapshot_ctas(spark, sf):
    _ensure_db(spark)
    name = _table_name("kpis_snapshot")
    v = views.v_fraud_kpis_daily(gold.events_daily_wide(_base(spark, sf)))
    snapshot_table(v, name, scratch_path(spark, "ctas"))
    return _finish(spark.table(name))


# ------------------------------------------------------------------- geo --

def q_geoip_range_join(spark, sf):
    e = geo_enrich(_silver(spark, sf), address_ranges(spark))
    return _finish(e.select("transaction_id", "device_ip", "country_iso2", "country_name", "latitude", "longitude"))


def q_geo_daily(spark, sf):
    return _finish(_geo(spark, sf, keep_unknown=False))


def q_geo_daily_keep_unknown(spark, sf):
    return _finish(_geo(spark, sf, keep_unknown=True))


def q_v_geo_daily(spark, sf):
    return _finish(views.v_geo_daily(_geo(spark, sf), AS_OF_DAY))


def q_v_geo_daily_weighted(spark, sf):
    return _finish(views.v_geo_daily_weighted(_geo(spark, sf), AS_OF_DAY))


def q_v_geo_dashboard_latlon(spark, sf):
    return _finish(views.v_geo_dashboard_latlon(spark, _geo(spark, sf), AS_OF_DAY))


def q_latest_geo_rows(spark, sf):
    return _finish(views.latest_rows(_geo(spark, sf), [F.desc("ds"), F.asc("country_iso2")], 10))


def _as_table(spark, df: DataFrame, stem: str, partition_col: str) -> str:
    _ensure_db(spark)
    path = scratch_path(spark, stem)
    write_partitioned(df, path, [partition_col])
    name = _table_name(stem)
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    tables.repair_partitions(spark, name)
    return name


def q_v_geo_passthrough(spark, sf):
    return _finish(views.passthrough(spark, _as_table(spark, _geo(spark, sf), "gold_geo", "ds")))


def q_v_gold_passthrough(spark, sf):
    wide = gold.events_daily_wide(_base(spark, sf))
    return _finish(views.passthrough(spark, _as_table(spark, wide, "gold_daily", "ds_day")))


def q_v_kpis_daily(spark, sf):
    return _finish(views.v_fraud_kpis_daily(gold.events_daily_wide(_base(spark, sf))))


def q_v_dashboard(spark, sf):
    return _finish(views.v_gold_fraud_dashboard(gold.events_daily_wide(_base(spark, sf))))


@contextlib.contextmanager
def _named_views(spark, sf):
    """A database of its own with both marts and the views over them; current
    while in use, as table functions are called by their bare names."""
    name, before = f"{DB}_views_{uuid.uuid4().hex[:10]}", spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE {name}")
    geo = _as_table(spark, _geo(spark, sf), "gold_geo", "ds")
    daily = _as_table(spark, gold.events_daily_wide(_base(spark, sf)), "gold_daily", "ds_day")
    views.create_view_functions(spark, geo, daily, name)
    spark.catalog.setCurrentDatabase(name)
    try:
        yield
    finally:
        spark.catalog.setCurrentDatabase(before)


def q_v_geo_daily_by_name(spark, sf):
    with _named_views(spark, sf):
        return _finish(spark.sql(f"SELECT * FROM v_geo_daily_90d(DATE'{AS_OF_DAY}')"))


def q_v_geo_dashboard_by_name(spark, sf):
    with _named_views(spark, sf):
        return _finish(spark.sql(f"SELECT * FROM v_geo_dashboard_latlon_90d(DATE'{AS_OF_DAY}')"))


def q_v_kpis_by_name(spark, sf):
    with _named_views(spark, sf):
        return _finish(spark.sql("SELECT * FROM v_fraud_kpis_daily"))


def q_v_dashboard_by_name(spark, sf):
    with _named_views(spark, sf):
        return _finish(spark.sql("SELECT * FROM v_gold_fraud_dashboard"))


# ------------------------------------------------------------- streaming --

def _incoming_lines(spark, sf) -> str:
    path = scratch_path(spark, "incoming")
    bronze_lines(_events(spark, sf)).select("value").write.mode("overwrite").text(path)
    return path


def q_stream_land_bronze(spark, sf):
    incoming = _incoming_lines(spark, sf)
    root, ckpt = scratch_path(spark, "stream-bronze"), scratch_path(spark, "ckpt-land")
    stream_jobs.land_bronze(spark, incoming, root, ckpt, fallback_day=F.lit(str(AS_OF_DAY)).cast("date"))
    return spark.read.text(root).groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("lines"))


def _validated_stream(spark, sf) -> str:
    root = _bronze_root(spark, sf)
    out, ckpt = scratch_path(spark, "stream-lake"), scratch_path(spark, "ckpt-validate")
    stream_jobs.validate_stream(spark, root, out, ckpt, as_of=as_of())
    return out


def q_stream_audit(spark, sf):
    audit = spark.read.parquet(f"{_validated_stream(spark, sf)}/audit")
    return audit.groupBy("ds_day", "dq_status").agg(F.sum("records").alias("records"))


def q_stream_validate(spark, sf):
    out = _validated_stream(spark, sf)
    s = spark.read.parquet(f"{out}/silver").select(F.lit("silver").alias("sink"), "ds_day", "dq_status")
    q = spark.read.parquet(f"{out}/quarantine").select(F.lit("quarantine").alias("sink"), "ds_day", "dq_status")
    return s.unionByName(q).groupBy("sink", "ds_day", "dq_status").agg(F.count(F.lit(1)).alias("records"))


def q_stream_dedup(spark, sf):
    src = scratch_path(spark, "stream-src")
    p = _payments(spark, sf).withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    p.write.mode("overwrite").parquet(src)
    out, ckpt = scratch_path(spark, "stream-dedup"), scratch_path(spark, "ckpt-dedup")
    stream_jobs.dedup_stream(spark, src, p.schema, out, ckpt)
    return spark.read.parquet(out).select("event_id")


def q_stream_dedup_batched(spark, sf):
    src = scratch_path(spark, "stream-src")
    p = _payments(spark, sf).withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    p.write.mode("overwrite").parquet(src)
    out, seen, ckpt = (scratch_path(spark, "stream-dedup-b"), scratch_path(spark, "stream-seen"),
                       scratch_path(spark, "ckpt-dedup-b"))
    stream_jobs.dedup_stream_batched(spark, src, p.schema, out, seen, ckpt)
    return spark.read.parquet(out).select("event_id")


# ------------------------------------------------------------- registry --

def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}
