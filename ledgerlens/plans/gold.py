"""Silver -> gold marts and the geo mart (rerun-safe, all touched days)."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import gold as marts
from ..operators.dedup import dedup_latest
from ..operators.geo import geo_daily, geo_enrich
from ..sinks.manifest import Manifest, done_version, mark_done, read_manifest, touched_since
from ..sinks.writers import (DEFAULT_PARALLEL_WRITES, clear_partitions, replace_folder, run_concurrently,
                             write_partitioned)
from .silver import read_sink
from .winners import DEDUP_ORDER, read_lost


# silver columns the marts read (gold_base dispatches on what is present)
GOLD_INPUT_COLUMNS = [
    "event_id", "transaction_id", "event_ts", "ingestion_ts", "merchant", "merchant_id", "approved",
    "approved_int", "status", "amount", "amount_double", "risk_score", "is_international",
    "is_international_int", "channel", "decline_reason", "payment_method", "card_id", "event_type", "mcc", "ds_day",
]
# silver columns the geo mart reads
GEO_INPUT_COLUMNS = [
    "event_id", "transaction_id", "event_ts", "ingestion_ts", "device_ip", "ds", "approved_int",
    "amount_double", "risk_score", "is_international_int", "ds_day",
]


# all event days of silver, as the ``days`` of a job
ALL_DAYS = "all"


def _on(df: DataFrame, days) -> DataFrame:
    if isinstance(days, str) and days == ALL_DAYS:
        return df
    return df.where(F.col("ds_day").isin([F.lit(str(d)).cast("date") for d in days]) if days else F.lit(False))


def lake_of(spark: SparkSession, silver_root: str) -> tuple[str, Manifest] | None:
    """The lake whose silver this is, with its newest commit; None for a plain
    folder of silver rows."""
    root, _, name = silver_root.rstrip("/").rpartition("/")
    manifest = read_manifest(spark, root) if name == "silver" else Manifest()
    return (root, manifest) if manifest.version else None


def silver_days(spark: SparkSession, silver_root: str, days, columns: list | None = None,
                lake: tuple[str, Manifest] | None = None) -> DataFrame:
    """Silver rows of the given event days (or ``ALL_DAYS``; an empty list: no
    rows) that are the latest copy of their event id among the copies of all
    days and all bronze batches, so the result for a day does not depend on the
    days it is computed with.  ``columns`` projects before the dedup, whose
    shuffle carries what the consumer reads.

    In a lake only those days are read: the index lists the ids of a day that
    count on another (``plans.winners``).  Of a plain folder the dedup's columns
    of the other days are read as well, for ids that occur on the given ones."""
    lake = lake or lake_of(spark, silver_root)
    df = read_sink(spark, lake[0], "silver", lake[1]) if lake else spark.read.parquet(silver_root)
    if columns:
        df = df.select(*[c for c in columns if c in df.columns])
    here = _on(df, days)
    if isinstance(days, str) and days == ALL_DAYS:
        return dedup_latest(here, "event_id", DEDUP_ORDER)
    if lake:
        # first one row for each id and then the list, so no id is large in the join
        lost = read_lost(spark, *lake, {str(d) for d in days})
        return dedup_latest(here, "event_id", DEDUP_ORDER).join(lost, ["event_id", "ds_day"], "left_anti").select(
            *here.columns)
    there = df.select("event_id", *DEDUP_ORDER, "ds_day").where("event_id IS NOT NULL")
    there = there.where(~F.col("ds_day").isin([F.lit(str(d)).cast("date") for d in days]) if days else F.lit(False))
    there = there.join(here.select("event_id").distinct(), "event_id", "left_semi")
    return _on(dedup_latest(here.unionByName(there, allowMissingColumns=True), "event_id", DEDUP_ORDER), days)


def touched_days(batch: DataFrame) -> list:
    """Event days present in a batch (one small distinct aggregate)."""
    return sorted(r["ds_day"] for r in batch.select("ds_day").distinct().collect() if r["ds_day"] is not None)


def affected_days(spark: SparkSession, silver_root: str, days) -> list:
    """The given days of a plain folder and those that hold other copies of
    their event ids: a later copy on a given day takes the event away from its
    old day."""
    df = spark.read.parquet(silver_root).select("event_id", "ds_day")
    ids = _on(df, days).select("event_id").where("event_id IS NOT NULL").distinct()
    others = touched_days(df.join(ids, "event_id", "left_semi"))
    return sorted({dt.date.fromisoformat(str(d)) for d in days} | set(others))


def _days_to_write(spark: SparkSession, silver_root: str, mart_root: str, days, lake):
    """The days asked for and, in a lake, those that commits have touched since
    these marts were last written."""
    if (isinstance(days, str) and days == ALL_DAYS) or not days:
        return days if days else []
    if not lake:
        return affected_days(spark, silver_root, days)
    done = done_version(spark, mart_root)
    open_days = set() if done is None else touched_since(spark, lake[0], done)
    if open_days is None:
        return ALL_DAYS
    return sorted({dt.date.fromisoformat(str(d)) for d in days} | {dt.date.fromisoformat(d) for d in open_days})


def _done(spark: SparkSession, mart_root: str, lake) -> None:
    if lake:
        mark_done(spark, mart_root, lake[1].version)


def _replace_days(df: DataFrame, path: str, column: str, days, filled: set) -> None:
    """Overwrite the partitions of ``days``: those with rows by the write, the
    others by clearing them.  All days: the whole folder."""
    if isinstance(days, str) and days == ALL_DAYS:
        replace_folder(df, path, [column], rebalance=True)
        return
    write_partitioned(df, path, [column], rebalance=True)
    clear_partitions(df.sparkSession, path, column, [d for d in days if d not in filled])


def silver_to_gold(spark: SparkSession, silver_root: str, gold_root: str, days,
                   top_n: int = K.TOP_N_MERCHANTS, strict: bool = False,
                   max_parallel: int = DEFAULT_PARALLEL_WRITES, strategy: str = "persist") -> dict[str, str]:
    """Recompute every mart for ``days`` and for the days that silver's commits
    have touched since these marts were last written, and replace exactly those
    days; days left without rows are cleared.  An empty list does nothing;
    ``ALL_DAYS`` recomputes everything.  After a run of a bronze day pass
    ``days`` of ``bronze_to_silver``.  A job that dies leaves its days
    outstanding, so the next one writes them.

    ``strategy='persist'``: the normalised base (needed columns only) is
    persisted once and feeds every mart (one silver scan instead of one per
    mart).  ``strategy='grouping_sets'``: the standard marts come from one
    GROUPING SETS aggregate (silver scanned and deduplicated once, no cache
    of the base); its small result is persisted and split per mart, top-N
    and the wide mart included.  Mart writes run as concurrent jobs."""
    out = {name: f"{gold_root.rstrip('/')}/{name}" for name in marts.MARTS}
    lake = lake_of(spark, silver_root)
    days = _days_to_write(spark, silver_root, gold_root, days, lake)
    if not days:
        return out
    base = marts.gold_base(silver_days(spark, silver_root, days, GOLD_INPUT_COLUMNS, lake), strict)
    if strategy == "grouping_sets":
        held, pick = marts.marts_one_pass(base)
        held = held.persist(StorageLevel.MEMORY_AND_DISK)
        frames = {name: fn(held) for name, fn in pick.items()}
        w = Window.partitionBy("ds_day").orderBy(F.desc("events_declined"), F.desc("events_total"),
                                                 F.asc_nulls_first("merchant_id_norm"))
        frames["top_merchants"] = (frames["by_merchant"].withColumn("rank", F.row_number().over(w))
                                   .where(F.col("rank") <= F.lit(int(top_n))))
    else:
        held = base.select("ds_day", "event_ts", "is_approved", "is_declined", "amount_num", "risk_score_num",
                           "is_international_num", "event_hour", "day_of_week", "channel", "decline_reason",
                           "merchant_id_norm", "merchant_country", "merchant_city", "merchant_mcc",
                           "payment_method", "card_id", "event_type").persist(StorageLevel.MEMORY_AND_DISK)
        frames = {name: fn(held, top_n) if name == "top_merchants" else fn(held) for name, fn in marts.MARTS.items()}
    try:
        # fills the cache once; the concurrent writes then share it
        filled = set(touched_days(held))
        run_concurrently([(lambda n=n: _replace_days(frames[n], out[n], "ds_day", days, filled))
                          for n in marts.MARTS], max_parallel)
    finally:
        held.unpersist()
    _done(spark, gold_root, lake)
    return out


def geo_to_gold(spark: SparkSession, silver_root: str, ranges: DataFrame, geo_root: str, days,
                keep_unknown: bool = False) -> str:
    """Geo mart for ``days`` (as ``silver_to_gold``): enrich by the range join,
    aggregate, replace those days (partition column ``ds``)."""
    lake = lake_of(spark, silver_root)
    days = _days_to_write(spark, silver_root, geo_root, days, lake)
    if not days:
        return geo_root
    silver = silver_days(spark, silver_root, days, GEO_INPUT_COLUMNS, lake)
    mart = geo_daily(geo_enrich(silver, ranges), keep_unknown).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        filled = {r["ds"] for r in mart.select("ds").distinct().collect()}
        _replace_days(mart, geo_root, "ds", days, filled)
    finally:
        mart.unpersist()
    _done(spark, geo_root, lake)
    return geo_root
