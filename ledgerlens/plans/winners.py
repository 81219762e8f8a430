"""Index of event ids: which copy of an event counts, and on which day.

Copies of one event id may lie on several event days and in several bronze
batches; only the latest counts.  Finding it by joining a day with all of
history would make a day's marts cost the history, and would forget an earlier
copy when the later one is corrected away.  So each silver run stores beside
its rows

* ``copies/run=R/bucket=B``: for each event id, bronze day and event day the
  greatest order key of its copies, in buckets by a hash of the id, and
* ``lost/run=R/ds_day=D``: the ids that have copies on day D but count on
  another day.

Both are part of the run's commit (``sinks.manifest``).  A run compares its
copies with those of the batch it replaces; for ids that differ it reads the
buckets they fall in, finds the day each counted on before and counts on now,
and rewrites the lists of lost ids of the days concerned.  A mart of day D then
reads silver of day D and its list, and nothing of other days.

Copies that tie in the order key have one event time and so one event day;
which of them is taken is settled among that day's rows.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.manifest import Manifest, commit, read_manifest, sweep
from ..sinks.writers import clear_folder, folder_exists, replace_folder

# latest ingest wins; then the later event time; transaction id breaks the
# remaining ties, so only byte-identical copies are left to choose between
DEDUP_ORDER = ["ingestion_ts", "event_ts", "transaction_id"]
COPIES_DDL = ("event_id string, bronze_day date, ds_day date, top struct<ingestion_ts: timestamp, "
              "event_ts: timestamp, transaction_id: string>, run string, bucket int")
LOST_DDL = "event_id string, run string, ds_day date"


def bucket_of(event_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(event_id), F.lit(buckets)).cast("int")


def write_copies(silver: DataFrame, root: str, run: str, buckets: int) -> None:
    """Store the copies of one run's silver rows (ids that are null have none)."""
    copies = (silver.where("event_id IS NOT NULL").groupBy("event_id", "bronze_day", "ds_day")
              .agg(F.max(F.struct(*DEDUP_ORDER)).alias("top"))
              .withColumn("bucket", bucket_of(F.col("event_id"), buckets)))
    replace_folder(copies, f"{root}/copies/run={run}", ["bucket"], rebalance=True)


def live_copies(spark: SparkSession, root: str, manifest: Manifest, runs=None) -> DataFrame:
    """The copies that count as present.  A run's files may hold bronze days that
    a later run has replaced; the table of live days (one row a bronze day)
    leaves those out."""
    live = {d: r for d, r in manifest.copies.items() if runs is None or r in runs}
    if not live:
        return spark.createDataFrame([], COPIES_DDL)
    days = spark.createDataFrame(sorted(live.items()), "bronze_day string, run string").select(
        F.col("bronze_day").cast("date").alias("bronze_day"), "run")
    df = spark.read.schema(COPIES_DDL).option("basePath", f"{root}/copies").parquet(
        *[f"{root}/copies/run={r}" for r in sorted(set(live.values()))])
    return df.join(F.broadcast(days), ["run", "bronze_day"], "left_semi")


def read_lost(spark: SparkSession, root: str, manifest: Manifest, days=None) -> DataFrame:
    """``(event_id, ds_day)`` that do not count on that day (of the given days)."""
    paths = [f"{root}/lost/run={r}/ds_day={d}" for d, r in sorted(manifest.lost.items())
             if days is None or d in days]
    if not paths:
        return spark.createDataFrame([], "event_id string, ds_day date")
    return spark.read.schema(LOST_DDL).option("basePath", f"{root}/lost").parquet(*paths).select("event_id", "ds_day")


def _changes(spark: SparkSession, root: str, manifest: Manifest, run: str, bronze_days: set) -> DataFrame:
    """Ids that count on another day than before, or are lost on other days: the
    day each counts on and the days it is lost on, before and now.  (Ids that
    came or went altogether have their days among those of the batch.)"""
    columns = ["event_id", "bronze_day", "ds_day", "top", "bucket"]
    own = F.col("bronze_day").isin([F.lit(d).cast("date") for d in sorted(bronze_days)]) if bronze_days else F.lit(False)
    fresh = (spark.read.schema(COPIES_DDL).option("basePath", f"{root}/copies").parquet(f"{root}/copies/run={run}")
             .select(*columns, F.lit(False).alias("was"), F.lit(True).alias("now")))
    ids = f"{root}/changed/run={run}"
    try:
        if manifest.copies:
            # what the run replaces was there, the rest of history is there before and after
            held = live_copies(spark, root, manifest).select(*columns, F.lit(True).alias("was"), (~own).alias("now"))
            batch = fresh.unionByName(held.where(own))
            before, after = (F.max(F.when(F.col(c), F.col("top"))) for c in ("was", "now"))
            changed = (batch.groupBy("event_id", "bucket", "bronze_day", "ds_day").agg(before.alias("before"), after.alias("after"))
                       .where("NOT (before <=> after)").select("event_id", "bucket").distinct())
            changed.write.mode("overwrite").parquet(ids)
            changed = spark.read.schema(changed.schema).parquet(ids)
            # only the buckets that hold changed ids are read, once for both parts
            touched = [r["bucket"] for r in changed.select("bucket").distinct().collect()]
            rows = fresh.unionByName(held.where(F.col("bucket").isin(touched) if touched else F.lit(False)))
        else:
            # nothing was there: only ids on several days are lost on any
            rows, day = fresh, F.col("ds_day")
            changed = (fresh.groupBy("event_id").agg(F.min(day).alias("first"), F.max(day).alias("last"),
                                                     F.count_if(day.isNull()).alias("dayless"))
                       .where("first <> last OR dayless > 0"))
        rows = rows.join(changed.select("event_id"), "event_id", "left_semi")

        def on(flag: str) -> list[Column]:
            day = F.when(F.col(flag), F.col("ds_day"))
            return [F.max(F.when(F.col(flag), F.struct("top", "ds_day")))["ds_day"].alias(f"day_{flag}"),
                    F.collect_set(day).alias(f"days_{flag}")]

        found = rows.groupBy("event_id").agg(*on("was"), *on("now"))
        for flag in ("was", "now"):
            elsewhere = F.array_except(f"days_{flag}", F.array(f"day_{flag}"))
            found = found.withColumn(f"lost_{flag}", F.array_sort(elsewhere)).drop(f"days_{flag}")
        found = found.where("lost_was <> lost_now OR day_was <> day_now")
        path = f"{root}/changes/run={run}"
        found.write.mode("overwrite").parquet(path)
        return spark.read.schema(found.schema).parquet(path)
    finally:
        clear_folder(spark, ids)


def _days(df: DataFrame, column: Column) -> set[str]:
    """Distinct event days of an array column (one row a day comes back)."""
    rows = df.select(F.explode(column).alias("day")).where("day IS NOT NULL").distinct().collect()
    return {str(r["day"]) for r in rows}


def commit_run(spark: SparkSession, root: str, run: str, batches: dict, whole: bool, buckets: int,
               base: Manifest, ledger: str = "") -> Manifest:
    """Make a staged run the content of its bronze days (``whole``: of the
    lake).  ``batches``: bronze day -> event days by sink."""
    replaced = set(base.batches) if whole else set(batches)
    days = {d for b in [*batches.values(), *(base.batches.get(k, {}) for k in replaced)] for d in b.get("silver", [])}
    changes = _changes(spark, root, base, run, replaced)
    moved = F.when(F.col("day_was") != F.col("day_now"), F.array("day_was", "day_now"))
    relisted = F.array_union(F.array_except("lost_was", "lost_now"), F.array_except("lost_now", "lost_was"))
    days |= _days(changes, moved)
    listed = _days(changes, relisted)
    lost = {d: r for d, r in base.lost.items() if d not in listed}
    if listed:
        kept = read_lost(spark, root, base, listed).join(changes.select("event_id"), "event_id", "left_anti")
        added = changes.select("event_id", F.explode("lost_now").alias("ds_day"))
        added = added.where(F.col("ds_day").isin([F.lit(d).cast("date") for d in sorted(listed)]))
        replace_folder(kept.unionByName(added), f"{root}/lost/run={run}", ["ds_day"], rebalance=True)
        lost |= {d: run for d in listed if folder_exists(spark, f"{root}/lost/run={run}/ds_day={d}")}
    kept_batches = {d: b for d, b in base.batches.items() if d not in replaced}
    now = {d: {"run": run} | b for d, b in batches.items() if b["silver"] or b["quarantine"]}
    held = {d: r for d, r in base.copies.items() if d not in replaced}
    new = commit(spark, root, replace(
        base, batches=kept_batches | now, copies=held | {d: run for d, b in batches.items() if b["silver"]},
        lost=lost, touched=sorted(days), buckets=buckets, ledger=ledger or base.ledger))
    sweep(spark, root, base, new)
    return new


def compact_copies(spark: SparkSession, root: str, run: str) -> Manifest:
    """Gather the copies of all runs into one folder, a file or few for each
    bucket, so that a lake of many daily runs opens few files."""
    root, base = root.rstrip("/"), read_manifest(spark, root)
    copies = live_copies(spark, root, base).select("event_id", "bronze_day", "ds_day", "top", "bucket")
    replace_folder(copies, f"{root}/copies/run={run}", ["bucket"], rebalance=True)
    new = commit(spark, root, replace(base, copies=dict.fromkeys(base.copies, run), touched=[]))
    sweep(spark, root, base, new)
    return new
