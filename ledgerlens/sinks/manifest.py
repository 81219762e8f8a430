"""Commits of a lake: which run's folders hold which bronze day.

A run writes every sink into folders of its own (``silver/run=R/...``) and then
one small numbered file, ``_manifest/00000007.json``, which names for each
bronze day the run that holds it.  Readers resolve the newest complete file, so
silver, quarantine, audit and the index of event ids change together or not at
all; a run that dies before its file is written leaves nothing but folders that
no one reads.  Each file also lists the event days whose marts its commit
touches.  Whoever derives tables from silver keeps the number of the last
commit it has worked off (``mark_done``) and asks for the days touched since
(``touched_since``), so a crash between silver and gold loses no day.

A file is created, never replaced: two runs that commit at one time get an
error, not a mixture.  It holds a line per bronze day.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import SparkSession

from .writers import _hadoop_path, folder_exists

SINKS = ("silver", "quarantine", "audit")
INDEX_BUCKETS = 32
DIGITS = 8


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    # bronze day -> {"run": R, "silver": [event days], "quarantine": [...]}
    batches: dict = field(default_factory=dict)
    copies: dict = field(default_factory=dict)    # bronze day -> run that holds its event ids
    lost: dict = field(default_factory=dict)      # event day -> run that lists the ids that count elsewhere
    touched: list = field(default_factory=list)   # event days whose marts this commit touches
    buckets: int = INDEX_BUCKETS
    ledger: str = ""                              # run that lists the landed files


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/_manifest"


def file_numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the files of a folder that are named by number."""
    fs, p = _hadoop_path(spark, folder)
    if not fs.exists(p):
        return []
    names = (s.getPath().getName().partition(".")[0] for s in fs.listStatus(p))
    return sorted(int(n) for n in names if n.isdigit())


def _numbered(folder: str, number: int) -> str:
    return f"{folder}/{number:0{DIGITS}d}.json"


def read_file(spark: SparkSession, folder: str, number: int) -> str:
    fs, p = _hadoop_path(spark, _numbered(folder, number))
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_file(spark: SparkSession, folder: str, number: int, text: str) -> None:
    """Write a file that must not be there yet."""
    fs, p = _hadoop_path(spark, _numbered(folder, number))
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read(spark: SparkSession, root: str, number: int) -> Manifest | None:
    """One commit, or None if its writer died while writing it."""
    try:
        return replace(Manifest(**json.loads(read_file(spark, _folder(root), number))), version=number)
    except ValueError:
        return None


def read_manifest(spark: SparkSession, root: str) -> Manifest:
    """The newest complete commit; version 0 where there is none."""
    for number in reversed(file_numbers(spark, _folder(root))):
        found = _read(spark, root, number)
        if found:
            return found
    return Manifest()


def commit(spark: SparkSession, root: str, manifest: Manifest) -> Manifest:
    """Write the commit after ``manifest.version``; an error if another run
    has committed since that one was read."""
    if read_manifest(spark, root).version != manifest.version:
        raise RuntimeError(f"another run has committed to {root}; run this one again")
    # a torn file keeps its number
    number = max(file_numbers(spark, _folder(root)), default=0) + 1
    create_file(spark, _folder(root), number, json.dumps(asdict(replace(manifest, version=number))))
    return replace(manifest, version=number)


def done_version(spark: SparkSession, consumer_root: str) -> int | None:
    """The last commit that the tables under ``consumer_root`` hold."""
    return max(file_numbers(spark, f"{consumer_root.rstrip('/')}/_lake"), default=None)


def mark_done(spark: SparkSession, consumer_root: str, version: int) -> None:
    fs, p = _hadoop_path(spark, f"{consumer_root.rstrip('/')}/_lake/{version:0{DIGITS}d}")
    fs.create(p, True).close()


def touched_since(spark: SparkSession, root: str, version: int) -> set[str] | None:
    """Event days touched by the commits after ``version``; None if commits in
    between are gone, so that everything has to be recomputed."""
    numbers = [n for n in file_numbers(spark, _folder(root)) if n > version]
    if numbers and numbers[0] != version + 1:
        return None
    found = [m for m in (_read(spark, root, n) for n in numbers) if m]
    return {day for m in found for day in m.touched}


def live_folders(root: str, manifest: Manifest, sink: str, bronze_days=None) -> list[str]:
    """The folders that hold a sink's rows (of the given bronze days)."""
    root = root.rstrip("/")
    own = "silver" if sink == "silver" else "quarantine"
    return [f"{root}/{sink}/run={b['run']}/bronze_day={day}" for day, b in sorted(manifest.batches.items())
            if (bronze_days is None or day in bronze_days)
            and (b[own] if sink != "audit" else b["silver"] or b["quarantine"])]


def sweep(spark: SparkSession, root: str, old: Manifest, new: Manifest) -> None:
    """Delete the folders that the commit ``new`` has replaced."""
    for sink in SINKS:
        for folder in set(live_folders(root, old, sink)) - set(live_folders(root, new, sink)):
            _delete(spark, folder)
    for name, before, after in (("copies", old.copies, new.copies), ("lost", old.lost, new.lost)):
        for run in set(before.values()) - set(after.values()):
            _delete(spark, f"{root.rstrip('/')}/{name}/run={run}")


def vacuum(spark: SparkSession, root: str, keep_commits: int = 1000) -> None:
    """Delete what no reader needs: folders of runs that never committed or are
    replaced, and all but the last commits.  Only while no run is under way."""
    now, root = read_manifest(spark, root), root.rstrip("/")
    alive = {f for sink in SINKS for f in live_folders(root, now, sink)}
    runs = {"copies": set(now.copies.values()), "lost": set(now.lost.values()), "changes": set(), "changed": set(),
            "staged": set(), "ledger": {now.ledger}}
    for sink in SINKS:
        for run in _children(spark, f"{root}/{sink}"):
            for day in _children(spark, run):
                if not any(day.endswith(f.removeprefix(root)) for f in alive):
                    _delete(spark, day)
    for name, kept in runs.items():
        for run in _children(spark, f"{root}/{name}"):
            if run.rpartition("run=")[2] not in kept:
                _delete(spark, run)
    for number in file_numbers(spark, _folder(root))[:-keep_commits]:
        _delete(spark, _numbered(_folder(root), number))


def _children(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _hadoop_path(spark, folder)
    return [s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory()] if folder_exists(spark, folder) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)
