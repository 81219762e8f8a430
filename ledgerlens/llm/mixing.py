"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled by a hash of their ids and laid end to
end; the line, walked again and again, is cut into equal blocks of ``block``
words.  Slot t of the schedule belongs to the source in whose share of the
cumulative targets the golden-ratio point ``(t + 1) * GOLDEN mod 2^64`` falls,
so every stretch of the schedule is close to the target mix.  Slots are ranked
within their source; the slot of rank r takes block r of its source.  Nothing is
added to the slots or cut from them but words beyond CAP turns of a line: what a
source gives differs from its target by the discrepancy of the points, a few
blocks.  ``sequence`` returns what each slot holds, ``mix`` sums it by document,
``copies`` places whole documents in the order of the slots.

Points and shares are compared in whole numbers, so the result does not depend
on rounding.  The order of a hot source is summed in two levels (hash prefixes,
then rows), as are the ranks of its slots (chunks of the schedule, then slots),
so no task holds a whole source; a block meets its documents by its place on the
line, which at most ``block`` documents share.  The source table itself, one row
a source, goes to the driver.

Defined cases: a null source is a source of its own, the last; null and empty
texts have size 0 and are never taken (``copies`` holds them once, in slot -1);
a null id is ordered first; repeated rows are documents of their own; very long
texts reach over many blocks; an empty table gives an empty result; columns
other than id, text, source and ``row_col`` are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, map_batches, materialize

GOLDEN = 0x9E3779B97F4A7C15   # 2^64 over the golden ratio, odd
CAP = 3                  # times its size that a source, and a document, may be taken
CHUNK = 1 << 16          # slots of the schedule that one row generates
CHUNKS = 64              # rows that one task turns into slots
PREFIX = 3               # hex digits of the id's hash that name a bucket of a source


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """One row a source: ``no`` (by code point, null last), its size, the weight
    that its place gives, and its target.  Targets share all sizes by weight; a
    source whose part would pass CAP times its size stops there."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("no"), F.lit(len(weights))) + 1).cast("int"))
    rows = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
            .withColumn("no", (F.row_number().over(by_name) - 1).cast("long"))
            .withColumn("weight", weight.cast("double")).withColumn("most", F.col("source_size") * float(CAP)))
    # sources by the level at which they are full; the first that stays below
    # the level left to it and those after it sets the level of all the rest
    full = Window.orderBy(F.col("most") / F.col("weight"), "no")
    every, rest = Window.partitionBy(), full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = F.coalesce(F.sum("most").over(full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    level = (F.sum("source_size").over(every) - before) / F.sum("weight").over(rest)
    rows = (rows.withColumn("level", level).withColumn("place", F.row_number().over(full))
            .withColumn("open", F.col("level") * F.col("weight") < F.col("most"))
            .withColumn("level", F.min_by("level", F.when(F.col("open"), F.col("place"))).over(every)))
    return rows.select("no", "source", "source_size", "weight", F.coalesce(
        F.least("most", F.col("level") * F.col("weight")), "most").alias("target"))


def shuffled_line(sizes: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """Every document's first word on its source's line (``at``) and a key of
    its own (``bucket``, ``row``)."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    docs = (sizes.join(targets.select("no", "source", "source_size", "target"),
                       sizes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
            .withColumn("order", order).withColumn("bucket", F.substring("order", 1, PREFIX)))
    per_bucket = docs.groupBy("no", "bucket").agg(F.sum("size").alias("in_bucket"))
    offsets = per_bucket.select("no", "bucket", (F.sum("in_bucket").over(
        Window.partitionBy("no").orderBy("bucket")) - F.col("in_bucket")).alias("offset"))
    rows = Window.partitionBy("no", "bucket").orderBy("order", "doc_id", "size", "key")
    return (docs.join(offsets, ["no", "bucket"])
            .withColumn("row", F.row_number().over(rows))
            .withColumn("at", F.col("offset") + F.sum("size").over(rows.rowsBetween(Window.unboundedPreceding, 0))
                        - F.col("size")).drop("offset", "order"))


def schedule(targets: DataFrame, block: int) -> DataFrame:
    """``(slot, no, rank)``: the source of each slot and the slot's rank among
    that source's."""
    spark = targets.sparkSession
    goals = [int(r["goal"]) for r in targets.orderBy("no").select(F.round("target").cast("long").alias("goal")).collect()]
    total = sum(goals)
    slots = -(-total // block)
    # the point p lies in the first source whose cumulative goal is beyond p * total / 2^64;
    # the last bound, 2^64 itself, is left out
    ends = np.cumsum(np.array(goals, object)) if total else []
    bounds = np.array([-(-(int(e) << 64) // total) for e in ends if e < total], np.uint64)
    def sources(c: int) -> np.ndarray:
        t = np.arange(c * CHUNK, min((c + 1) * CHUNK, slots), dtype=np.int64)
        return np.searchsorted(bounds, (t + 1).astype(np.uint64) * np.uint64(GOLDEN), side="right")

    def count():
        def run(batch):
            (c,) = column(batch, "chunk").to_pylist()
            counts = np.bincount(sources(c))
            no = np.flatnonzero(counts)
            return {"chunk": np.full(len(no), c), "no": no, "count": counts[no]}
        return run

    def draw():
        def run(batch):
            ((c, nos, befores),) = zip(*(column(batch, n).to_pylist() for n in ("chunk", "nos", "befores")))
            no = sources(c)
            by_no = np.argsort(no, kind="stable")
            counts = np.bincount(no)
            rank = np.empty(len(no), np.int64)
            rank[by_no] = np.arange(len(no)) - np.repeat(np.cumsum(counts) - counts, counts)
            before = np.zeros(len(counts), np.int64)
            before[nos] = befores
            return {"slot": c * CHUNK + np.arange(len(no)), "no": no, "rank": rank + before[no]}
        return run

    chunks = spark.range(-(-slots // CHUNK)).withColumnRenamed("id", "chunk")
    counted = map_batches(chunks, count, dict.fromkeys(("chunk", "no", "count"), "long"), rows=1)
    before = F.sum("count").over(Window.partitionBy("no").orderBy("chunk")) - F.col("count")
    ranked = (counted.withColumn("before", before).groupBy("chunk")
              .agg(F.collect_list(F.struct("no", "before")).alias("_")).selectExpr(
                  "chunk", "_.no as nos", "_.before as befores"))
    # a chunk's row is small, so adaptive execution would leave all chunks to one task
    ranked = ranked.repartition(max(1, -(-slots // (CHUNK * CHUNKS))), "chunk")
    return map_batches(ranked, draw, dict.fromkeys(("slot", "no", "rank"), "long"), rows=1)


def _in_cells(rows: DataFrame, begin: Column, end: Column, block: int) -> DataFrame:
    """Each stretch ``[begin, end)`` of a line once for each cell of ``block``
    words that it meets, as ``lo`` and ``hi`` inside the cell; an empty one once."""
    cells = F.sequence(F.floor(begin / block), F.floor((F.greatest(end, begin + 1) - 1) / block))
    return (rows.withColumn("cell", F.explode(cells))
            .withColumn("lo", F.greatest(begin, F.col("cell") * block))
            .withColumn("hi", F.least(end, (F.col("cell") + 1) * block)))


def _placed(docs: DataFrame, weights: tuple[float, ...], block: int, seed: int,
            id_col: str, text_col: str, source_col: str, row_col: str | None) -> DataFrame:
    """What each slot takes of each document: ``words`` of it from ``first`` on,
    in turn ``turn`` of its source's line.  A part of a document that no slot
    takes has no slot and no words."""
    key = F.col(f"`{row_col}`") if row_col else F.lit(0)
    sizes = materialize(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), key.cast("long").alias("key"),
        word_count(F.col(f"`{text_col}`")).alias("size")), "mix-sizes")
    targets = materialize(source_targets(sizes, weights), "mix-targets")
    # a slot's block as stretches of its source's line, one for each turn it meets
    size, start = F.col("source_size"), F.col("rank") * block
    stop = F.least(start + block, size * CAP)
    turns = F.sequence(F.expr(f"rank * {block} div source_size"), F.expr("(stop - 1) div source_size"))
    stretches = (schedule(targets, block).join(targets.where("source_size > 0").select("no", "source_size"), "no")
                 .withColumn("stop", stop).where(F.col("stop") > start).withColumn("turn", F.explode(turns)))
    stretches = _in_cells(stretches, F.greatest(start - F.col("turn") * size, F.lit(0)),
                          F.least(F.col("stop") - F.col("turn") * size, size), block)
    stretches = stretches.select("no", "cell", "slot", "rank", "turn", F.col("lo").alias("from"), F.col("hi").alias("to"))
    line = shuffled_line(sizes, targets, seed)
    pieces = _in_cells(line, F.col("at"), F.col("at") + F.col("size"), block)
    first, last = F.greatest("lo", "from"), F.least("hi", "to")
    # both sides grow with the corpus, and compress to far less than they take in memory
    return (pieces.join(stretches.hint("merge"), ["no", "cell"], "left")
            .withColumn("words", F.when(F.col("slot").isNull(), 0).otherwise(F.greatest(last - first, F.lit(0))))
            .withColumn("first", first - F.col("at")))


def sequence(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), block: int = 32, seed: int = 42,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             row_col: str | None = None) -> DataFrame:
    """The mix in its order: ``slot, source, rank`` (the block of its source),
    ``turn, at`` (the document's place on its source's line), ``doc_id, key``
    (``row_col``), ``first`` and ``words`` (what the slot takes of the document)."""
    return (_placed(docs, weights, block, seed, id_col, text_col, source_col, row_col).where("words > 0")
            .select("slot", "source", "rank", "turn", "at", "doc_id", "key", "first", "words"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), block: int = 32, seed: int = 42,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target`` and
    ``taken``, the words that the schedule's slots take of it."""
    return (_placed(docs, weights, block, seed, id_col, text_col, source_col, None)
            .groupBy("no", "bucket", "row", "doc_id", "source", "size", "source_size", "target")
            .agg(F.sum("words").cast("long").alias("taken"))
            .select("doc_id", "source", "size", "source_size", "target", "taken"))


def copies(docs: DataFrame, row_col: str, weights: tuple[float, ...] = (5, 2, 1), block: int = 32, seed: int = 42,
           id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Whole documents in place of the slots' words: ``key`` (``row_col``, which
    names a row) once for each turn in which slots take at least half of its words,
    with the ``slot`` of the first, ``turn`` and ``at`` to order by.  Documents
    without words come once, first."""
    return (_placed(docs, weights, block, seed, id_col, text_col, source_col, row_col)
            .where("words > 0 or size = 0")
            .groupBy("key", "turn", "at", "size").agg(F.sum("words").alias("words"), F.min("slot").alias("slot"))
            .where("2 * words >= size")
            .selectExpr("key", "if(size = 0, -1, slot) as slot", "if(size = 0, 0, turn) as turn", "at").distinct())


def oracle_sql(weights: tuple[float, ...] = (5, 2, 1), block: int = 32, seed: int = 42) -> str:
    """DuckDB SQL for ``mix``.  A source's ranks have no gaps, so its slots take
    whole turns around its line, then the line's beginning."""
    return rf"""
with sizes as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size from documents),
src as (
  select *, 3.0::double * source_size as most, [{", ".join(map(str, weights))}][no % {len(weights)} + 1]::double as weight from (
    select source, sum(size)::bigint as source_size,
           row_number() over (order by source is null, source) - 1 as no from sizes group by source)),
lev as (
  select *, (sum(source_size) over () - coalesce(sum(most) over (order by most / weight, no
             rows between unbounded preceding and 1 preceding), 0))::double
            / sum(weight) over (order by most / weight, no rows between current row and unbounded following) as level,
         row_number() over (order by most / weight, no) as place from src),
tgt as (
  select *, least(most, coalesce(weight * (select l.level from lev l where l.level * l.weight < l.most
                                           order by l.place limit 1), most)) as target from lev),
ends as (
  select no, source_size, sum(round(target)::hugeint) over (order by no) as until,
         sum(round(target)::hugeint) over () as total from tgt),
points as (
  select ((t + 1)::hugeint * {GOLDEN}) % 18446744073709551616 as point, t
  from generate_series(0::bigint, (select coalesce(max((total + {block} - 1) // {block}), 0) - 1 from ends)::bigint) g(t)),
drawn as (
  select no, any_value(source_size) as source_size, count(*) as slots from (
    select t, (select min(no) from ends where point * total < until * 18446744073709551616) as no from points)
  join ends using (no) group by no),
carry as (select no, least(slots * {block}, {CAP} * source_size)::bigint as goal from drawn),
line as (
  select doc_id, size, source_size, target, coalesce(goal, 0) as goal,
         sum(size) over (partition by no order by md5('{seed}:' || coalesce(doc_id::varchar, '')), doc_id, size
                         rows between unbounded preceding and current row)::bigint - size as line_at
  from sizes join tgt on sizes.source is not distinct from tgt.source left join carry using (no))
select doc_id, size, source_size, target,
       case when source_size = 0 then 0 else size * (goal // source_size)
            + greatest(least(line_at + size, goal % source_size) - line_at, 0) end::bigint as taken
from line"""
