"""Bronze is parsed once a run, in tasks that keep all cores busy."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from ledgerlens import registry
from ledgerlens.functions import json as json_functions
from ledgerlens.functions import parse_event_ts, unglue_fragments
from ledgerlens.operators import quality
from ledgerlens.plans import silver as S
from ledgerlens.plans import winners
from ledgerlens.session import TASKS_PER_CORE, lake_session, scratch_path
from ledgerlens.sinks.writers import folder_bytes, folder_exists
from ledgerlens.streaming import jobs as stream_jobs

from test_reruns import as_of, land, line

LINES = {5: [line("a", 4), line("b", 5), "{broken"], 6: [line("c", 5), line("", 5)]}


def counting(spark, fragments):
    """``fragments``, and how many of them have been computed."""
    seen = spark.sparkContext.accumulator(0)

    def look(text):
        seen.add(1)
        return text

    return fragments.withColumn("raw_line", F.udf(look, "string")("raw_line")), seen


def test_a_batch_is_parsed_once(spark, monkeypatch):
    bronze, root, seen = scratch_path(spark, "once-bronze"), scratch_path(spark, "once"), []
    land(spark, bronze, LINES)
    unglue = S.unglue

    def watched(raw):
        fragments, n = counting(spark, unglue(raw))
        seen.append(n)
        return fragments

    monkeypatch.setattr(S, "unglue", watched)
    S.bronze_to_silver(spark, bronze, root, None, as_of=as_of(), whole_events=True)
    assert [n.value for n in seen] == [5]
    assert S.read_sink(spark, root, "silver").count() == 3
    bad = S.read_sink(spark, root, "quarantine", whole_events=True)
    rows = {r["raw_line"]: r for r in bad.select("raw_line", "dq_status", "event_ts", "ingestion_ts", "source_file", "event").collect()}
    assert set(rows) == {"{broken", LINES[6][1]}
    assert rows["{broken"]["event"] is None and rows[LINES[6][1]]["event"] is not None
    assert isinstance(rows[LINES[6][1]]["event_ts"], str) and all(r["source_file"] and r["ingestion_ts"] for r in rows.values())
    assert not [c for c in spark.read.parquet(f"{root}/silver").columns if c.startswith("_")]
    assert not [p for p in S.SINKS if not folder_exists(spark, f"{root}/{p}")]
    assert folder_bytes(spark, f"{root}/staged") == 0


def test_a_micro_batch_is_parsed_once(spark, monkeypatch):
    bronze, root, seen = scratch_path(spark, "stream-once-bronze"), scratch_path(spark, "stream-once"), []
    land(spark, bronze, LINES)
    unglue = stream_jobs.unglue

    def watched(raw):
        fragments, n = counting(spark, unglue(raw))
        seen.append(n)
        return fragments

    monkeypatch.setattr(stream_jobs, "unglue", watched)
    stream_jobs.validate_stream(spark, bronze, root, scratch_path(spark, "stream-once-ckpt"), as_of=as_of())
    assert [n.value for n in seen] == [5]
    assert spark.read.parquet(f"{root}/silver").count() == 3
    assert spark.read.parquet(f"{root}/quarantine").count() == 2


def test_events_of_one_row_group_are_dealt(spark, monkeypatch):
    lake_session(spark)
    assert int(spark.conf.get("spark.sql.files.minPartitionNum")) == TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(registry, "LINE_PART_BYTES", folder_bytes(spark, f"{sf}/events.parquet") // 2)
    dealt = registry._dealt_events(spark, sf)
    assert dealt.rdd.getNumPartitions() > 1
    assert dealt.count() == spark.read.parquet(f"{sf}/events.parquet").count()


def test_quotes_and_times(spark):
    """Escaped quotes and a last backslash do not close a literal; only a text with
    the mark of the slashed format is read by it."""
    texts = ['{"a":"x\\"}{"}', '{"a":"x\\\\"}{"b":1}', '{"a":"x}{', '{"a":1} {"b":"}{"}\\']
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    found = [r[0] for r in df.select(unglue_fragments(F.col("c"))).collect()]
    assert found == [[texts[0]], ['{"a":"x\\\\"}', '{"b":1}'], ['{"a":"x}', '{'], ['{"a":1}', '{"b":"}{"}\\']]
    times = spark.createDataFrame([("05/01/2024 03:04:05",), ("2024-01-05T03:04:05Z",), ("5/1",), (None,)], "t string")
    got = [str(r[0]) for r in times.select(parse_event_ts(F.col("t")).cast("string")).collect()]
    assert got == ["2024-01-05 03:04:05", "2024-01-05 03:04:05", "None", "None"]


def test_unescaped_quotes_are_counted_without_rebuilding_the_line(spark):
    lines = ['{"a":"x\\\\"}{"b":1}', '{"a":"x\\"}{"}', '{"a":"\\\\\\"}{"}{"b":2}', '{"a":"open}{"b":1}', '{"a":"}{"}', None]
    df = spark.createDataFrame([(t,) for t in lines], "v string").select(unglue_fragments(F.col("v")).alias("f"))
    assert [r["f"] for r in df.collect()] == [
        ['{"a":"x\\\\"}', '{"b":1}'], ['{"a":"x\\"}{"}'], ['{"a":"\\\\\\"}{"}', '{"b":2}'], ['{"a":"open}', '{"b":1}'],
        ['{"a":"}{"}'], None]
    assert "regexp_replace" not in df._jdf.queryExecution().analyzed().toString()


def test_history_of_ids_is_read_once_a_commit(spark, monkeypatch):
    bronze, root, held = scratch_path(spark, "ids-bronze"), scratch_path(spark, "ids"), []
    land(spark, bronze, LINES | {7: [line("a", 5, txn="later")]})
    live = winners.live_copies

    def watched(*args):
        held.append(live(*args))
        return held[-1]

    monkeypatch.setattr(winners, "live_copies", watched)
    S.bronze_to_silver(spark, bronze, root, None, as_of=as_of())
    assert not held  # no history yet
    lost = winners.read_lost(spark, root, S.read_manifest(spark, root))
    assert [(r["event_id"], str(r["ds_day"])) for r in lost.collect()] == [("a", "2024-01-04")]
    land(spark, bronze, LINES)
    found, changes = [], winners._changes
    monkeypatch.setattr(winners, "_changes", lambda *args: found.append(changes(*args)) or found[-1])
    S.bronze_to_silver(spark, bronze, root, "2024-01-07", as_of=as_of())
    assert len(held) == 1 and not winners.read_lost(spark, root, S.read_manifest(spark, root)).count()
    assert [(str(r["day_was"]), str(r["day_now"])) for r in found[0].collect()] == [("2024-01-05", "2024-01-04")]
    assert folder_bytes(spark, f"{root}/changed") == 0 and not spark.sparkContext._jsc.getPersistentRDDs()


def test_corrected_files_are_landed_for_their_days_only(spark):
    root = scratch_path(spark, "landed-again")
    land(spark, root, LINES | {4: [line("stray", 4)]})
    before = {r[0] for r in spark.read.text(root).select("_metadata.file_path").distinct().collect()}
    rows = [(v, "2024", "01", f"{d:02d}") for d, v in ((5, "five"), (6, "six"), (7, "seven"))]
    lines = spark.createDataFrame(rows, "value string, year string, month string, day string")
    registry._land_again(lines, root, [dt.date(2024, 1, 4), dt.date(2024, 1, 5)])
    now = spark.read.text(root).select("value", "day", "_metadata.file_path").collect()
    assert {(r["value"], r["day"]) for r in now} == {("five", 5)} | {(v, 6) for v in LINES[6]}
    assert {r["file_path"] for r in now if r["day"] == 6} < before


def test_braces_in_literals_need_no_cut(spark):
    """Of lines of every combination of marks, those told to be one object are what
    the cut makes of them, and quotes close as counted one by one."""
    lines = ["".join(p) for n in range(1, 6) for p in itertools.product('{}"\\ ', repeat=n)]
    lines += ['{"a":"x}{1"}', '{"a":"\\"}{"}', '{"a":"}{"}{"b":1}', '{"a":"x}{"} ', '{"é":"}\n{"}\n', '{"a":"' + "\\\\" * 9000 + '}{"}']
    df = spark.createDataFrame([(t,) for t in lines], "c string").select(
        "c", unglue_fragments(F.col("c")).alias("f"), F.col("c").rlike(json_functions.LITERALS_CLOSE).alias("close"),
        F.col("c").rlike(json_functions.ONE_LINE).alias("one"), F.col("c").rlike(json_functions.GLUED).alias("glued"),
        F.regexp_extract_all("c", F.lit(json_functions.ONE_OBJECT), F.lit(1)).alias("cut"),
        F.split("c", json_functions.BETWEEN).alias("split"))
    for r in df.collect():
        plain = r["c"].replace("\\\\", "").replace('\\"', "")
        assert r["close"] == (plain.count('"') % 2 == 0), r["c"]
        assert r["f"] == ([r["c"]] if not r["glued"] else r["cut"] if r["close"] else r["split"]), r["c"]
        assert not (r["glued"] and r["one"]) or len(r["f"]) == 1
    assert [f for (f,) in df.where("c like '%x}{1%'").select("one").collect()] == [True]


def test_silver_is_written_by_the_pass_that_parses(spark, monkeypatch):
    """Only the quarantine's rows are staged; they come back as they were graded."""
    bronze, root = scratch_path(spark, "routed-bronze"), scratch_path(spark, "routed")
    land(spark, bronze, LINES | {7: ['{"event_id":"", "x":"}{,"}', '{"é":1} {"b":2}']})
    left, clear = [], S.clear_folder

    def watched(s, path):
        if "/staged/" in path:
            left.append([r["dq_status"] for r in s.read.parquet(path).select("dq_status").collect()])
        clear(s, path)

    monkeypatch.setattr(S, "clear_folder", watched)
    S.bronze_to_silver(spark, bronze, root, None, as_of=as_of())
    assert left == [["BAD"] * 5]
    names = quality.QUARANTINE_COLUMNS
    graded = S.validate_bronze(spark, bronze, as_of=as_of())
    want = quality.quarantine_view(graded.withColumn("bronze_day", S.bronze_day_of(graded)), keep=("bronze_day",))
    got = S.read_sink(spark, root, "quarantine")
    assert sorted(map(str, got.select(*names, "bronze_day").collect())) == sorted(map(str, want.collect())) and got.count() == 5
    silver = S.to_silver(quality.good_rows(graded)).drop("ds_day")
    assert sorted(map(str, S.read_sink(spark, root, "silver").select(*silver.columns).collect())) == sorted(map(str, silver.collect()))
    assert folder_bytes(spark, f"{root}/staged") == 0
