"""Streaming jobs.

* ``land_bronze``: raw JSON lines from a file drop -> day-partitioned gzip
  text (the landing the event producer's delivery stream does).
* ``validate_stream``: the batch validation on each micro-batch, routed to
  silver and quarantine by ``foreachBatch``.  Output goes to
  ``batch_id=N/ds_day=D``, and a micro-batch replayed after a failure replaces
  its own folder instead of appending twice.
* ``dedup_stream``: drop repeated event ids within a watermark; state is
  bounded by the watermark delay, NULL ids pass through untouched.

All use ``trigger(availableNow=True)`` by default (process what is there,
then stop) and keep their checkpoint under the given shared folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import day_parts, parse_event_ts, unglue_fragments, with_columns_once
from ..operators import quality
from ..plans.silver import staged_sinks
from ..sinks.writers import folder_exists, replace_folder, run_concurrently, write_partitioned
from ..sources.bronze import parse_events, unglue

# files of one micro-batch: a backlog is worked off in bounded steps
FILES_PER_TRIGGER = 256
# ways a key is split before its copies meet in one task
DEDUP_SALTS = 32


def line_day(value: Column, fallback_day: Column) -> Column:
    """Landing day of a raw line: the day of its first object's event time, else
    ``fallback_day`` (the arrival day)."""
    first = F.from_json(F.get(unglue_fragments(value), F.lit(0)), "event_ts string, event_time string")
    ts = F.coalesce(parse_event_ts(first["event_ts"]), parse_event_ts(first["event_time"]))
    return F.coalesce(F.to_date(ts), fallback_day)


def _run(writer, available_now: bool = True):
    q = (writer.trigger(availableNow=True) if available_now else writer).start()
    if available_now:
        q.awaitTermination()
    return q


def land_bronze(spark: SparkSession, incoming: str, bronze_root: str, checkpoint: str,
                fallback_day: Column | None = None, max_files_per_trigger: int = FILES_PER_TRIGGER,
                available_now: bool = True):
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger).load(incoming)
    arrived = fallback_day if fallback_day is not None else F.current_date()
    # parsed once per line, not once per date part
    out = with_columns_once(lines.select("value"), {"_day": line_day(F.col("value"), arrived)})
    out = out.select("value", *[c.alias(name) for name, c in day_parts(F.col("_day")).items()])
    w = (out.writeStream.format("text").option("compression", "gzip")
            .option("checkpointLocation", checkpoint).partitionBy("year", "month", "day")
            .outputMode("append").option("path", bronze_root))
    return _run(w, available_now)


def validate_stream(spark: SparkSession, bronze_root: str, out_root: str, checkpoint: str,
                    as_of: Column | None = None, strict: bool = False,
                    max_files_per_trigger: int = FILES_PER_TRIGGER, available_now: bool = True):
    """Stream bronze lines through un-glue, parse and grading; each
    micro-batch writes its GOOD/WARN rows to ``out_root/silver``, its BAD
    rows to ``out_root/quarantine`` and the counts of both to
    ``out_root/audit``.  A batch owns its ``batch_id=N`` folder of each sink
    and replaces it whole when replayed.  A batch is parsed once, into a folder
    that both sinks are made from; the audit counts what they hold."""
    src = (spark.readStream.format("text").option("recursiveFileLookup", "true")
           .option("maxFilesPerTrigger", max_files_per_trigger))
    raw = src.load(bronze_root).select(
        F.col("value").alias("raw_line"), F.col("_metadata.file_path").alias("source_file"),
        (as_of if as_of is not None else F.current_timestamp()).alias("ingestion_ts"))
    graded = quality.validate(parse_events(unglue(raw)), as_of=as_of, strict=strict)
    root = out_root.rstrip("/")

    def route(batch: DataFrame, batch_id: int) -> None:
        own = {sink: f"{root}/{sink}/batch_id={batch_id}" for sink in ("silver", "quarantine", "audit")}
        with staged_sinks(batch, f"{root}/staged/batch_id={batch_id}", strict) as rows:
            run_concurrently([lambda s=s, df=df: replace_folder(df, own[s], ["ds_day"], rebalance=s == "quarantine")
                              for s, df in rows.items()])
        kept = [batch.sparkSession.read.schema("dq_status string, ds_day date").parquet(own[s])
                for s in ("silver", "quarantine")]
        audit = (kept[0].unionByName(kept[1]).groupBy("ds_day", "dq_status").agg(F.count(F.lit(1)).alias("records"))
                 .withColumn("audit_ts", F.current_timestamp()))
        replace_folder(audit, own["audit"], ["ds_day"])

    w = graded.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
    return _run(w, available_now)


def dedup_events(stream: DataFrame, key: str = "event_id", event_time: str = "event_ts",
                 delay: str = "1 day") -> DataFrame:
    """First copy of each ``key`` within ``delay`` of event time.  Rows with a
    NULL key are not duplicates of each other and are kept.

    Two steps, so that a key with a large share of the stream is never one
    task's: the first drops copies of a key that were read by the same of
    ``DEDUP_SALTS`` groups of input tasks, the second the at most
    ``DEDUP_SALTS`` copies left.  Each holds an entry per key (and group) for
    ``delay``, evicted by the watermark."""
    salted = stream.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(DEDUP_SALTS)))
    s = salted.withWatermark(event_time, delay)
    kept = (s.where(F.col(key).isNotNull()).dropDuplicatesWithinWatermark([key, "_salt"])
            .dropDuplicatesWithinWatermark([key]))
    return kept.unionByName(s.where(F.col(key).isNull())).drop("_salt")


def dedup_stream(spark: SparkSession, source: str, schema: T.StructType, out_path: str, checkpoint: str,
                 key: str = "event_id", event_time: str = "event_ts", delay: str = "1 day",
                 max_files_per_trigger: int = FILES_PER_TRIGGER, available_now: bool = True):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source)
    w = (dedup_events(stream, key, event_time, delay).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).option("path", out_path).outputMode("append"))
    return _run(w, available_now)


def rows_dropped_by_watermark(query) -> int:
    """Late rows a stateful query dropped (older than its watermark), summed
    over the progress reports Spark keeps for the query."""
    total = 0
    for progress in query.recentProgress or []:
        for op in progress.get("stateOperators", []):
            total += int(op.get("numRowsDroppedByWatermark", 0) or 0)
    return total


def dedup_stream_batched(spark: SparkSession, source: str, schema: T.StructType, out_path: str, seen_path: str,
                         checkpoint: str, key: str = "event_id", event_time: str = "event_ts",
                         delay_days: int | None = None, max_files_per_trigger: int = FILES_PER_TRIGGER,
                         available_now: bool = True):
    """Streaming dedup without state in memory.

    One rule within a micro-batch and across them: a row goes if a copy of its
    key was kept, or, with ``delay_days``, if one was kept whose event day is at
    most so far from its own.  Days of a batch are taken in order and of a day's
    copies the earliest, so files that arrive by event day give the same keys and
    days however they fall into batches.

    A batch is first reduced to one row for each key and day by the batch operator
    (partial aggregation: all copies of a hot key collapse inside each task).  The
    keys already kept are stored by event day, then batch.  With ``delay_days`` a
    batch opens only the folders of days that near to its own, so an old row costs
    its day; without, it scans the keys (not the rows) of all history.  A batch owns its ``batch_id=N`` folders and
    consults only those of earlier batches, so a replayed micro-batch reproduces
    its own output exactly.  Rows with a NULL key pass through, with ``delay_days``
    those with a NULL time too; without, such a copy is the last to be kept.
    """
    from ..operators.dedup import dedup_latest

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source)
    seen_schema = T.StructType([T.StructField(key, schema[key].dataType), T.StructField("ds_day", T.DateType()),
                                T.StructField("batch_id", T.LongType())])
    seen_path = seen_path.rstrip("/")

    def step(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        # earliest copy wins: order by the negated time; only rows with both are copies of anything
        ranked = (batch.withColumn("_neg_ts", -F.col(event_time).cast("double"))
                  .withColumn("_day", F.to_date(event_time) if delay_days is not None
                              else F.coalesce(F.to_date(event_time), F.lit(dt.date.max)))
                  .withColumn("_copy", F.when(F.col(key).isNotNull() & F.col("_day").isNotNull(), F.struct(key, "_day"))))
        others = [c for c in batch.columns if c != event_time]
        first = dedup_latest(ranked, "_copy", ["_neg_ts", *others]).drop("_neg_ts").persist()
        try:
            copies = first.where(F.col("_copy").isNotNull()).select(key, "_day")
            folders = [seen_path]
            if delay_days is not None:
                days = [r["_day"] for r in copies.select("_day").distinct().collect()]
                near = {d + dt.timedelta(days=k) for d in days for k in range(-delay_days, delay_days + 1)}
                folders = [f"{seen_path}/ds_day={d}" for d in sorted(near)]
            stored = [p for p in folders if folder_exists(own, p)]
            held = copies.select(key, "_day", F.lit(False).alias("_seen"))
            if stored:
                # a day's folder may be opened before or after this batch's own
                # first attempt wrote there: only earlier batches count
                seen = (own.read.schema(seen_schema).option("basePath", seen_path).parquet(*stored)
                        .where(F.col("batch_id") < batch_id).select(key, F.col("ds_day").alias("_day"))
                        .join(copies.select(key).distinct(), key, "left_semi"))
                held = held.union(seen.select(key, "_day", F.lit(True)))
            by_key = held.groupBy(key).agg(
                F.array_sort(F.collect_list(F.when(~F.col("_seen"), F.col("_day")))).alias("_new"),
                F.collect_set(F.when(F.col("_seen"), F.col("_day"))).alias("_old"))
            def copied(d, o):
                return F.lit(True) if delay_days is None else F.abs(F.date_diff(d, o)) <= delay_days

            kept_days = F.aggregate("_new", F.expr("cast(array() as array<date>)"), lambda kept, d: F.when(
                F.exists(F.concat(F.col("_old"), kept), lambda o: copied(d, o)), kept)
                .otherwise(F.concat(kept, F.array(d))))
            kept = by_key.select(F.col(key), F.explode(kept_days).alias("_day")).select(F.struct(key, "_day").alias("_copy"))
            fresh = first.join(kept, "_copy", "left_semi").unionByName(first.where(F.col("_copy").isNull()))
            write_partitioned(fresh.select(*batch.columns, F.lit(batch_id).cast("long").alias("batch_id")), out_path,
                              ["batch_id"])
            ids = kept.select(f"_copy.{key}", F.col("_copy._day").alias("ds_day"),
                              F.lit(batch_id).cast("long").alias("batch_id"))
            write_partitioned(ids, seen_path, ["ds_day", "batch_id"], rebalance=True)
        finally:
            first.unpersist()

    w = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return _run(w, available_now)
