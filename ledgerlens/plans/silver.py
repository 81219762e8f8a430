"""Bronze -> silver: un-glue, parse, validate, route, audit."""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (boolish_to_int, country_iso2, country_name, is_international,
                         parse_event_ts, risk_bucket, safe_col)
from ..operators import quality
from ..sinks.catalog import AUDIT_DDL, QUARANTINE_DDL, SILVER_DDL
from ..sinks.manifest import SINKS, Manifest, live_folders, read_manifest
from ..sinks.writers import clear_folder, folder_exists, move_folder, replace_folder, run_concurrently
from ..sources.bronze import parse_events, read_bronze, unglue, whole_event
from ..sources.ledger import landed_files, open_days, read_ledger, write_ledger
from .winners import commit_run, write_copies

# --- fixed values: columns of silver -----------------------------------------
SILVER_COLUMNS = [
    "event_id", "transaction_id", "user_id", "card_id", "customer_id", "merchant_id", "merchant", "mcc", "amount",
    "currency", "payment_method", "channel", "country", "region", "city", "device_id", "device", "device_os",
    "device_ip", "velocity_1h", "distance_km_from_home", "metadata", "source", "schema_version", "risk_score", "is_international", "status", "approved", "decline_reason",
    "event_type", "event_ts", "ingestion_ts", "source_file", "dq_status", "dq_errors",
    "amount_double", "approved_int", "is_international_int", "country_iso2", "country_geo",
    "risk_bucket", "ds", "ds_day",
]


def approved_int(df: DataFrame, strict: bool = False) -> Column:
    """1/0 approval: ``approved`` text, else (unless strict) the status."""
    a = boolish_to_int(safe_col(df, "approved", "string"))
    if strict or "status" not in df.columns:
        return a
    st = F.upper(F.trim(F.col("status")))
    return F.coalesce(a, F.when(st == "APPROVED", 1).when(st == "DECLINED", 0))


def to_silver(validated: DataFrame, strict: bool = False, keep: tuple = ()) -> DataFrame:
    """Canonical silver layout from validated rows: one schema for every
    writer and reader (event time as timestamp, ``ds``/``ds_day`` dates,
    ``device_ip``, numeric approval/international flags, ISO2 country).
    ``keep`` names further columns to carry, such as other event fields."""
    df = validated
    ip = F.coalesce(safe_col(df, "device_ip", "string"), safe_col(df, "ip_address", "string"))
    cols = {
        **{c: safe_col(df, c, "string") for c in (
            "event_id", "transaction_id", "user_id", "card_id", "merchant_id", "merchant",
            "currency", "payment_method", "channel", "country", "region", "city", "device_id",
            "customer_id", "mcc", "device", "device_os", "metadata", "source", "schema_version",
            "status", "approved", "decline_reason", "event_type", "source_file", "dq_status")},
        "amount": safe_col(df, "amount", "double"),
        "device_ip": ip,
        "risk_score": safe_col(df, "risk_score", "double"),
        "velocity_1h": safe_col(df, "velocity_1h", "double"),
        "distance_km_from_home": safe_col(df, "distance_km_from_home", "double"),
        "is_international": safe_col(df, "is_international", "int"),
        "event_ts": F.col("event_ts_ts"),
        # the producer's ingest time when the event carries one, else the
        # time the batch read the line
        "ingestion_ts": F.coalesce(parse_event_ts(safe_col(df, "ingest_time", "string")),
                                   safe_col(df, "ingest_timestamp", "timestamp"),
                                   safe_col(df, "ingestion_ts", "timestamp")),
        "dq_errors": F.col("dq_errors"),
        "amount_double": safe_col(df, "amount", "double"),
        "approved_int": approved_int(df, strict),
        "is_international_int": is_international(safe_col(df, "is_international", "string")),
        "country_iso2": country_iso2(df, strict),
        "risk_bucket": risk_bucket(safe_col(df, "risk_score", "double")),
        "ds": F.col("ds_day"),
        "ds_day": F.col("ds_day"),
    }
    out = df.select(*[cols[c].alias(c) for c in SILVER_COLUMNS if c not in ("country_geo",)], *keep)
    out = out.withColumn("country_geo", country_name(F.col("country_iso2")))
    return out.select(*SILVER_COLUMNS, *keep)


def validate_bronze(spark: SparkSession, bronze_root: str, day: str | list | None = None,
                    as_of: Column | None = None, strict: bool = False,
                    partitions: int | None = None) -> DataFrame:
    """Scan (one day, several or the whole tree), un-glue, parse and grade."""
    raw = read_bronze(spark, bronze_root, day=day, as_of=as_of, partitions=partitions)
    return quality.validate(parse_events(unglue(raw)), as_of=as_of, strict=strict)


def bronze_day_of(df: DataFrame) -> Column:
    """The bronze folder day of each line (from the year/month/day partitions)."""
    return F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))


# the quarantine's columns that silver lacks or holds in another form
_BAD_ONLY = {"raw_line": "string", "dq_hard_errors": "array<string>", "event_ts": "string", "ingestion_ts": "timestamp"}


@contextlib.contextmanager
def staged_sinks(graded: DataFrame, path: str, strict: bool = False, keep: tuple = (), whole_events: bool = False):
    """Silver's and the quarantine's rows of ``graded``, which is computed once
    and written to ``path`` for as long as they are in use.  A line's text is
    staged for the quarantine only, unless ``whole_events`` asks for the record of
    each line, ``event``, which is made of the staged text."""
    if "source_file" not in graded.columns:
        graded = graded.withColumn("source_file", F.lit(None).cast("string"))
    bad = F.col("dq_status") == "BAD"
    own = {c: F.when(bad, F.col(c).cast(t)) if c in graded.columns else F.lit(None).cast(t) for c, t in _BAD_ONLY.items()}
    if whole_events:
        own["raw_line"] = F.col("raw_line")
    held = graded.withColumn("_bad", F.struct(*[c.alias(n) for n, c in own.items()]))
    spark, staged = graded.sparkSession, to_silver(held, strict, keep=(*keep, "_bad"))
    staged.write.mode("overwrite").parquet(path)
    rows = spark.read.schema(staged.schema).parquet(path)
    if whole_events:
        rows, keep = rows.withColumn("event", whole_event("_bad.raw_line")), (*keep, "event")
    view = [F.col(f"_bad.{c}").alias(c) if c in _BAD_ONLY else F.col(c) for c in quality.QUARANTINE_COLUMNS]
    try:
        yield {"silver": quality.good_rows(rows).drop("_bad"),
               "quarantine": quality.bad_rows(rows).select(*view, *keep)}
    finally:
        clear_folder(spark, path)


def write_routed(graded: DataFrame, staged: str, silver_path: str, strict: bool = False) -> None:
    """Write silver's rows to ``silver_path`` and the BAD ones to
    ``staged/sink=quarantine``, in one pass over ``graded``: both go to one folder,
    split by sink and days, of which silver's part is then moved.

    The files of one write have one layout, silver's.  What only the quarantine
    needs of a BAD row stands before its codes, in ``dq_errors``
    (``routed_quarantine`` takes it out again)."""
    spark, bad = graded.sparkSession, F.col("dq_status") == "BAD"
    text, hard = _as_text(graded), F.col("dq_hard_errors")
    own = F.array(*[text[c] for c in _ROUTED_TEXT], F.size(hard).cast("string"))
    routed = graded.withColumn("dq_errors", F.when(bad, F.concat(own, hard, "dq_errors")).otherwise(F.col("dq_errors")))
    rows = to_silver(routed, strict, keep=("bronze_day",))
    sink = F.when(bad, F.lit("quarantine")).otherwise(F.lit("silver"))
    replace_folder(rows.withColumn("sink", sink), staged, ["sink", "bronze_day", "ds_day"])
    if folder_exists(spark, f"{staged}/sink=silver"):
        move_folder(spark, f"{staged}/sink=silver", silver_path)
    else:
        replace_folder(rows.limit(0), silver_path, ["bronze_day", "ds_day"])


_ROUTED_TEXT = ("raw_line", "event_ts", "ingestion_ts")


def _as_text(graded: DataFrame) -> dict[str, Column]:
    """The quarantine's own fields as text; a time by its microseconds."""
    found = {c: F.col(c).cast("string") if c in graded.columns else F.lit(None).cast("string") for c in ("raw_line", "event_ts")}
    at = F.unix_micros(F.col("ingestion_ts").cast("timestamp")) if "ingestion_ts" in graded.columns else F.lit(None)
    return found | {"ingestion_ts": at.cast("string")}


def routed_quarantine(spark: SparkSession, staged: str) -> DataFrame:
    """The quarantine's rows that ``write_routed`` left."""
    path, first = f"{staged}/sink=quarantine", len(_ROUTED_TEXT) + 2
    if not folder_exists(spark, path):
        return spark.createDataFrame([], QUARANTINE_DDL)
    codes, hard = F.col("dq_errors"), F.get("dq_errors", F.lit(first - 2)).cast("int")
    own = {c: F.get(codes, F.lit(i)) for i, c in enumerate(_ROUTED_TEXT)}
    own["ingestion_ts"] = F.timestamp_micros(own["ingestion_ts"].cast("long"))
    own["dq_hard_errors"] = F.slice(codes, F.lit(first), hard)
    own["dq_errors"] = F.slice(codes, F.lit(first) + hard, F.size(codes))
    return spark.read.schema(SILVER_DDL).parquet(path).select(
        *[own[c].alias(c) if c in own else F.col(c) for c in quality.QUARANTINE_COLUMNS], "bronze_day")


SINK_DDL = {"silver": SILVER_DDL, "quarantine": QUARANTINE_DDL, "audit": AUDIT_DDL}


def read_sink(spark: SparkSession, out_root: str, sink: str, manifest: Manifest | None = None,
              whole_events: bool = False) -> DataFrame:
    """Silver, quarantine or audit as last committed (or as of ``manifest``);
    empty if there is nothing yet.  ``whole_events`` adds ``event``, the record
    as it came (NULL in rows of runs that did not keep it)."""
    root = out_root.rstrip("/")
    layout = ("event variant, " if whole_events else "") + SINK_DDL[sink]
    paths = live_folders(root, manifest or read_manifest(spark, root), sink)
    if not paths:
        return spark.createDataFrame([], SINK_DDL[sink]).selectExpr(
            *(["CAST(NULL AS variant) AS event"] if whole_events else []), "*")
    df = spark.read.schema(layout + ", run string").option("basePath", f"{root}/{sink}").parquet(*paths)
    return df.drop("run")


def stage_batch(validated: DataFrame, out_root: str, bronze_day: str | list | None, run: str, buckets: int,
                strict: bool = False, whole_events: bool = False) -> dict:
    """Write one run: GOOD/WARN -> silver, BAD -> quarantine, the audit of both
    and the index of silver's event ids, all in folders of the run, which no
    reader sees before the commit.  Returns bronze day -> event days by sink.
    ``whole_events`` keeps each record beside its typed columns, as a VARIANT.

    Bronze is read, parsed and graded once: that map-only pass writes silver's files
    and, to ``staged/run=R``, the rows of the quarantine, which is made from there
    (with whole records both sinks are made from what is staged); the audit counts
    what they wrote."""
    spark, root = validated.sparkSession, out_root.rstrip("/")
    day = F.lit(bronze_day).cast("date") if isinstance(bronze_day, str) else bronze_day_of(validated)
    graded = validated.withColumn("bronze_day", day)
    paths = {s: f"{root}/{s}/run={run}" for s in SINKS}
    staged, days = f"{root}/staged/run={run}", ["bronze_day", "ds_day"]
    if whole_events:
        with staged_sinks(graded, staged, strict, ("bronze_day",), whole_events) as rows:
            run_concurrently([lambda s=s, df=df: replace_folder(df, paths[s], days, rebalance=s == "quarantine")
                              for s, df in rows.items()])
    else:
        try:
            write_routed(graded, staged, paths["silver"], strict)
            replace_folder(routed_quarantine(spark, staged), paths["quarantine"], days, rebalance=True)
        finally:
            clear_folder(spark, staged)
    written = {s: spark.read.schema(SINK_DDL[s]).parquet(paths[s]) for s in ("silver", "quarantine")}

    def audit() -> list:
        keys = ["bronze_day", "ds_day", "dq_status"]
        counted = (written["silver"].select(*keys).union(written["quarantine"].select(*keys)).groupBy(*keys)
                   .agg(F.count(F.lit(1)).alias("records")).withColumn("audit_ts", F.current_timestamp()))
        replace_folder(counted, paths["audit"], ["bronze_day", "ds_day"])
        # one row for each pair of days and grade
        return spark.read.schema(AUDIT_DDL).parquet(paths["audit"]).select(*keys).collect()

    found, _ = run_concurrently([audit, lambda: write_copies(written["silver"], root, run, buckets)])
    own = [bronze_day] if isinstance(bronze_day, str) else bronze_day or []
    batches: dict = {d: {"silver": [], "quarantine": []} for d in own}
    for r in found:
        b = batches.setdefault(str(r["bronze_day"]), {"silver": [], "quarantine": []})
        sink = "quarantine" if r["dq_status"] == "BAD" else "silver"
        event_day = None if r["ds_day"] is None else str(r["ds_day"])
        if event_day not in b[sink]:
            b[sink].append(event_day)
    return batches


def write_silver_batch(validated: DataFrame, out_root: str, bronze_day: str | list | None,
                       strict: bool = False, files: DataFrame | None = None, whole_events: bool = False) -> dict:
    """Stage one bronze day or several (``None``: the whole tree) and commit
    them, with the ledger of ``files`` if given.

    A run replaces its bronze day in every sink by one commit, so rows that a
    corrected rerun moves to another event day, to the other sink or nowhere
    leave no old copy, and a run that dies leaves the state before it.

    Returns the three roots; ``days``, the event days that silver had for this
    batch before or has now; and ``touched``, those and the days on which events
    count or no longer count because of it.  The commit keeps the latter, and
    the mart jobs work off what is outstanding."""
    spark, root = validated.sparkSession, out_root.rstrip("/")
    base, run = read_manifest(spark, root), "r" + uuid.uuid4().hex[:12]
    ledger = run if files is not None else ""
    if ledger:
        # before the lines are read: a file that lands meanwhile is new to the next run
        write_ledger(files, root, run)
    batches = stage_batch(validated, root, bronze_day, run, base.buckets, strict, whole_events)
    new = commit_run(spark, root, run, batches, bronze_day is None, base.buckets, base, ledger)
    replaced = {k: b for k, b in base.batches.items() if bronze_day is None or k in batches}
    days = {d for b in [*batches.values(), *replaced.values()] for d in b["silver"]}
    return ({s: f"{root}/{s}" for s in SINKS} | {"days": sorted(map(dt.date.fromisoformat, days)),
                                                 "touched": sorted(map(dt.date.fromisoformat, new.touched))})


def bronze_to_silver(spark: SparkSession, bronze_root: str, out_root: str, bronze_day: str | None,
                     as_of: Column | None = None, strict: bool = False,
                     partitions: int | None = None, whole_events: bool = False) -> dict:
    """Job: one bronze day (``None``: the whole tree, each line keeping its
    own folder day) -> silver + quarantine + audit (rerun-safe).  With
    ``whole_events`` no field of a record is lost (``read_sink`` gives it back)."""
    validated = validate_bronze(spark, bronze_root, day=bronze_day, as_of=as_of, strict=strict,
                                partitions=partitions)
    return write_silver_batch(validated, out_root, bronze_day, strict, whole_events=whole_events)


def landed_to_silver(spark: SparkSession, bronze_root: str, out_root: str, as_of: Column | None = None,
                     strict: bool = False, partitions: int | None = None, whole_events: bool = False) -> dict:
    """Job: run the bronze days that have a new, changed or vanished file since
    the last run, all in one commit.  Returns what ``bronze_to_silver`` does and
    ``bronze_days``, the days run; an unchanged tree is not read."""
    root = out_root.rstrip("/")
    base, files = read_manifest(spark, root), landed_files(spark, bronze_root)
    due = open_days(read_ledger(spark, root, base.ledger), files)
    if not due:
        return {s: f"{root}/{s}" for s in SINKS} | {"days": [], "touched": [], "bronze_days": []}
    validated = validate_bronze(spark, bronze_root, day=due, as_of=as_of, strict=strict, partitions=partitions)
    return write_silver_batch(validated, root, due, strict, files, whole_events) | {"bronze_days": due}
