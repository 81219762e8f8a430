"""Commits of a lake and the index of event ids."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.plans import gold as gold_jobs
from ledgerlens.plans import silver as S
from ledgerlens.plans import winners as W
from ledgerlens.session import scratch_path
from ledgerlens.sinks import manifest as M
from ledgerlens.sinks.writers import folder_exists

from test_reruns import as_of, counts, ids, land, line


class Lake:
    def __init__(self, spark, name):
        self.spark, self.root, self.bronze = spark, scratch_path(spark, name), scratch_path(spark, f"{name}-bronze")

    def land(self, by_day):
        land(self.spark, self.bronze, by_day)

    def silver(self, day):
        return S.bronze_to_silver(self.spark, self.bronze, self.root, day, as_of=as_of())

    def gold(self, days):
        marts = gold_jobs.marts.MARTS
        gold_jobs.marts.MARTS = {"kpis_daily": marts["kpis_daily"]}  # one mart tells
        try:
            gold_jobs.silver_to_gold(self.spark, f"{self.root}/silver", f"{self.root}/gold", days)
        finally:
            gold_jobs.marts.MARTS = marts

    def run(self, day):
        out = self.silver(day)
        self.gold(out["days"])
        return out

    def counts(self):
        return counts(self.spark, self.root)


TWICE = {5: [line("e", 4, txn="early"), line("x", 4)], 6: [line("e", 5, txn="late"), line("y", 5)]}
ONCE = {5: TWICE[5], 6: TWICE[6][1:]}


@pytest.fixture()
def lake(spark):
    """An event with an early copy on the 4th and a late one on the 5th."""
    lake = Lake(spark, "commits")
    lake.land(TWICE)
    lake.run("2024-01-05")
    assert lake.counts() == {"2024-01-04": 2}
    lake.run("2024-01-06")
    assert lake.counts() == {"2024-01-04": 1, "2024-01-05": 2}
    return lake


def test_a_removed_copy_gives_the_event_back(lake):
    lake.land(ONCE)
    out = lake.run("2024-01-06")
    assert [str(d) for d in out["touched"]] == ["2024-01-04", "2024-01-05"]
    assert lake.counts() == {"2024-01-04": 2, "2024-01-05": 1}
    assert M.read_manifest(lake.spark, lake.root).lost == {}


def test_a_run_that_dies_between_sinks_leaves_the_old_state(lake, monkeypatch):
    before = [ids(lake.spark, lake.root, s) for s in ("silver", "quarantine")]
    lake.land({5: TWICE[5], 6: [line("y", 5, status="LOST")]})

    def dies(*args, **kw):
        raise OSError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(S, "write_copies", dies)
        with pytest.raises(OSError):
            lake.silver("2024-01-06")
    with monkeypatch.context() as m:
        m.setattr(W, "commit", dies)
        with pytest.raises(OSError):
            lake.silver("2024-01-06")
    assert [ids(lake.spark, lake.root, s) for s in ("silver", "quarantine")] == before
    lake.gold(gold_jobs.ALL_DAYS)
    assert lake.counts() == {"2024-01-04": 1, "2024-01-05": 2}
    lake.run("2024-01-06")
    assert lake.counts() == {"2024-01-04": 2}
    assert ids(lake.spark, lake.root, "quarantine") == [("t-y", "2024-01-05")]


def test_a_run_that_dies_before_gold_leaves_its_days_outstanding(lake):
    lake.land({5: [line("x", 4)], 6: [line("y", 7)]})
    lake.silver("2024-01-05")
    lake.silver("2024-01-06")         # each dies before its marts are written
    out = lake.run("2024-01-06")      # and the last of them is started again
    assert [str(d) for d in out["days"]] == ["2024-01-07"]
    assert lake.counts() == {"2024-01-04": 1, "2024-01-07": 1}


def test_marts_that_die_are_written_by_the_next_job(lake, monkeypatch):
    lake.land(ONCE)
    out = lake.silver("2024-01-06")
    with monkeypatch.context() as m:
        m.setattr(gold_jobs, "_replace_days", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            lake.gold(out["days"])
    lake.land({5: TWICE[5], 6: ONCE[6], 9: [line("z", 9)]})
    lake.run("2024-01-09")
    assert lake.counts() == {"2024-01-04": 2, "2024-01-05": 1, "2024-01-09": 1}


def test_two_runs_at_one_time_do_not_mix(lake):
    base = M.read_manifest(lake.spark, lake.root)
    lake.run("2024-01-06")
    with pytest.raises(RuntimeError, match="run this one again"):
        M.commit(lake.spark, lake.root, base)


def test_a_torn_commit_is_not_read(lake):
    last = M.read_manifest(lake.spark, lake.root)
    fs, p = M._hadoop_path(lake.spark, f"{lake.root}/_manifest/{last.version + 1:08d}.json")
    out = fs.create(p, False)
    out.write(bytearray(b'{"version": 9, "batches": {"2024'))
    out.close()
    assert M.read_manifest(lake.spark, lake.root) == last
    lake.land(ONCE)
    lake.run("2024-01-06")
    assert M.read_manifest(lake.spark, lake.root).version == last.version + 2
    assert lake.counts() == {"2024-01-04": 2, "2024-01-05": 1}


def test_a_run_reads_only_the_buckets_of_its_changed_ids(lake, monkeypatch):
    lake.land({5: TWICE[5], 6: TWICE[6] + [line("new", 5)]})
    seen = []
    real = W.live_copies

    def spy(*args):
        df = real(*args)
        seen.append(df)
        return df

    monkeypatch.setattr(W, "live_copies", spy)
    lake.silver("2024-01-06")
    changed = lake.spark.createDataFrame([("new",)], "event_id string")
    bucket = changed.select(W.bucket_of(F.col("event_id"), M.INDEX_BUCKETS)).first()[0]
    pruned = seen[0].where(F.col("bucket").isin([bucket]))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and f"bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # the ids that stay as they are move no day
    assert M.read_manifest(lake.spark, lake.root).touched == ["2024-01-05"]


def test_a_mart_day_reads_its_own_folders_only(lake):
    rows = gold_jobs.silver_days(lake.spark, f"{lake.root}/silver", ["2024-01-04"])
    assert [r.transaction_id for r in rows.collect()] == ["t-x"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scans = [part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]]
    assert any("ds_day" in s and "2024-01-04" in s for s in scans)


def test_compaction_and_vacuum_change_no_result(lake):
    S.stage_batch(S.validate_bronze(lake.spark, lake.bronze, day="2024-01-06", as_of=as_of()), lake.root,
                  "2024-01-06", "rdead", M.INDEX_BUCKETS)
    W.compact_copies(lake.spark, lake.root, "rgathered")
    assert set(M.read_manifest(lake.spark, lake.root).copies.values()) == {"rgathered"}
    M.vacuum(lake.spark, lake.root, keep_commits=1)
    assert not folder_exists(lake.spark, f"{lake.root}/silver/run=rdead/bronze_day=2024-01-06")
    assert not folder_exists(lake.spark, f"{lake.root}/copies/run=rdead")
    assert ids(lake.spark, lake.root, "silver") == sorted(
        [("early", "2024-01-04"), ("t-x", "2024-01-04"), ("late", "2024-01-05"), ("t-y", "2024-01-05")])
    lake.land(ONCE)
    lake.run("2024-01-06")  # commits are gone: the marts are written anew
    assert lake.counts() == {"2024-01-04": 2, "2024-01-05": 1}


def test_random_reruns_equal_a_lake_built_at_once(spark):
    import random
    deal = random.Random(7)
    lake = Lake(spark, "random")
    content = {}
    for _ in range(3):
        for day in deal.sample(range(4, 8), 2):
            content[day] = [line(f"e{deal.randrange(6)}", deal.randrange(3, 9), txn=f"t{deal.randrange(99)}",
                                 status=deal.choice(["APPROVED", "APPROVED", "DECLINED", "LOST"])) for _ in range(deal.randrange(6))]
            lake.land(content)
            out = lake.silver(f"2024-01-{day:02d}")
            if deal.random() < 0.7:
                lake.gold(out["days"] or out["touched"])
    lake.gold(gold_jobs.touched_days(S.read_sink(spark, lake.root, "silver")) or [])
    whole = Lake(spark, "whole")
    whole.land(content)
    whole.silver(None)
    whole.gold(gold_jobs.ALL_DAYS)
    a, b = (sorted(map(tuple, spark.read.parquet(f"{x.root}/gold/kpis_daily").collect()), key=str) for x in (lake, whole))
    assert a == b
