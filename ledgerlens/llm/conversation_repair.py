"""Repair of conversation structure by a dynamic program over a grammar.

A conversation's rows, in order, are symbols: the role's initial (system, user,
assistant or other) and the row's first fault (blank, duplicate, truncated or
none).  The cheapest edits that leave roles of the form ``(s?(ua)+)?`` are a
shortest path through four states (nothing yet, after system, after user, after
assistant).  A symbol is a matrix of such paths from state to state, each with
its cost and its audit (the edits' letters), and a sequence is the min-plus
product of its matrices, ties going to the ASCII-least audit.  That product may
be bracketed at will: audits of equal cost over the same rows differ within
their letters, as one cannot be the beginning of the other (it would cost the
inserts more), so the least parts make the least whole.

Sequences repeat, within and across conversations.  Each distinct one is solved
once, and those of a batch are compressed by Re-Pair (the most frequent pairs
become rules, round by round): a rule's matrix is the product of its two sides,
evaluated bottom-up and used by every sequence that holds it.  Audits are ropes
and become text only where two of equal cost are compared.

Spark's part: faults are columns; the first row of each role and text is found
by an aggregate; narrow rows (a digest, no text) are sorted by range, so that a
conversation of any length is split over tasks, and come out as one letter a
row; texts move once, to be written out repaired in order.  The digest of a
whole repaired conversation reads it in one stream by its nature, holding one
batch.  A conversation's letters, like its audit, are one value.

Order: by turn, nulls first; rows of one turn by the SHA-256 of role and text.

Defined cases: a null role or text is one blank (such a text is a blank row); a
null turn sorts first and counts for no gap; rows of a null id are one
conversation with that id; repeated rows are duplicates of each other; an
empty table gives an empty result; long texts are hashed and written batch by
batch; columns other than the four are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, column, ddl, map_batches, materialize

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3     # faults; 0: none
REROLE, DELETE, INSERT, KEEP_TRUNCATED = 2, 3, 2, 1  # costs
START, SYSTEM, USER, ASSISTANT = range(4)  # states
INITIALS = "suax"                          # role classes; x: any other
FOLLOWS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LEGAL = {"su", "ua", "au"}
ROLES = {USER: "user", ASSISTANT: "assistant"}
BATCH_ROWS = 1000
BATCH_CHARS = 4_000_000
PIECE = 1_000_000          # letters of a piece of a conversation
SOLVE_ROWS = 4096          # distinct sequences compressed together


# ------------------------------------------------------------- the program --

class Rope:
    """A text as a tree of its parts; it is joined when first asked for."""

    __slots__ = ("parts",)

    def __init__(self, *parts):
        self.parts = parts

    def __str__(self) -> str:
        if len(self.parts) != 1 or not isinstance(self.parts[0], str):
            out, todo = [], list(reversed(self.parts))
            while todo:
                part = todo.pop()
                if isinstance(part, str):
                    out.append(part)
                else:
                    todo.extend(reversed(part.parts))
            self.parts = ("".join(out),)
        return self.parts[0]


Matrix = list  # 16 entries, (cost, rope) or None, from state i to state j at 4 * i + j


def better(old, cost: int, *parts):
    """The cheaper of two paths, then the one with the lesser audit."""
    if old is None or cost < old[0]:
        return cost, Rope(*parts)
    if cost == old[0] and str(rope := Rope(*parts)) < str(old[1]):
        return cost, rope
    return old


def product(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = [None] * 16
    for i in range(4):
        for k in range(4):
            if (x := a[4 * i + k]) is not None:
                for j in range(4):
                    if (y := b[4 * k + j]) is not None:
                        out[4 * i + j] = better(out[4 * i + j], x[0] + y[0], x[1], y[1])
    return out


def _inserts() -> Matrix:
    """Paths by inserts alone: at most two are needed to reach any state."""
    out: Matrix = [(0, Rope("")) if i == j else None for i in range(4) for j in range(4)]
    for _ in range(2):
        for i in range(4):
            for k in range(4):
                for step in (FOLLOWS["u"], FOLLOWS["a"]):
                    if out[4 * i + k] is not None and k in step:
                        at = 4 * i + step[k]
                        out[at] = better(out[at], out[4 * i + k][0] + INSERT, out[4 * i + k][1], "I")
    return out


INSERTS = _inserts()


def row_matrix(initial: str, fault: int) -> Matrix:
    """Inserts before a row, then what may be done with it."""
    own: Matrix = [None] * 16
    for i in range(4):
        own[5 * i] = better(own[5 * i], DELETE, "D")
        if fault not in (BLANK, DUPLICATE):
            extra = KEEP_TRUNCATED if fault == TRUNCATED else 0
            for role, cost, letter in [(initial, 0, "K"), ("u", REROLE, "R"), ("a", REROLE, "R")]:
                if i in FOLLOWS.get(role, {}):
                    at = 4 * i + FOLLOWS[role][i]
                    own[at] = better(own[at], cost + extra, letter)
    return product(INSERTS, own)


def letter_of(initial: str, fault: int) -> str:
    return chr(ord("A") + 4 * INITIALS.index(initial) + fault)


TERMINALS = [row_matrix(initial, fault) for initial in INITIALS for fault in range(4)]


def re_pair(sequences: list[str]) -> tuple[list[np.ndarray], list[tuple[int, int]]]:
    """The sequences with frequent pairs replaced by rules, and the rules: rule
    ``k`` is symbol ``16 + k``.  In each round all pairs at least half as
    frequent as the best are replaced, as long as they share no symbol."""
    rules: list[tuple[int, int]] = []
    ends = np.cumsum([len(s) + 1 for s in sequences])
    flat = np.full(int(ends[-1]) if len(ends) else 0, -1, np.int64)
    for s, end in zip(sequences, ends.tolist(), strict=True):
        flat[end - 1 - len(s):end - 1] = np.frombuffer(s.encode(), np.uint8).astype(np.int64) - ord("A")
    while len(flat) > 1:
        base = 16 + len(rules)
        both = (flat[:-1] >= 0) & (flat[1:] >= 0)
        codes = np.where(both, flat[:-1] * base + flat[1:], -1)
        pairs, counts = np.unique(codes[both], return_counts=True)
        if not len(pairs) or counts.max() < 2:
            break
        chosen, used = [], set()
        for at in np.lexsort((pairs, -counts)).tolist():
            if counts[at] < max(2, counts.max() // 2):
                break
            pair = divmod(int(pairs[at]), base)
            if not used & set(pair):
                used |= set(pair)
                chosen.append((int(pairs[at]), 16 + len(rules)))
                rules.append(pair)
        chosen.sort()
        known, names = (np.array(x, np.int64) for x in zip(*chosen, strict=True))
        place = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        hits = np.flatnonzero(known[place] == codes)
        # in a row of one symbol every other pair is replaced
        first = np.r_[True, np.diff(hits) != 1]
        offset = np.arange(len(hits)) - np.maximum.accumulate(np.where(first, np.arange(len(hits)), 0))
        hits = hits[offset % 2 == 0]
        flat[hits] = names[place[hits]]
        flat = np.delete(flat, hits + 1)
    return [part[part >= 0] for part in np.split(flat, np.flatnonzero(flat == -1))[:len(sequences)]], rules


def solve(sequences: list[str]) -> list[tuple[int, str]]:
    """Least cost and audit of each sequence."""
    short, rules = re_pair(sequences)
    matrices = list(TERMINALS)
    for left, right in rules:
        matrices.append(product(matrices[left], matrices[right]))
    out = []
    for symbols in short:
        level = [matrices[k] for k in symbols.tolist()]
        while len(level) > 1:
            pairs = [product(*level[k:k + 2]) for k in range(0, len(level) - 1, 2)]
            level = pairs + level[len(pairs) * 2:]
        whole = product(level[0], INSERTS) if level else INSERTS
        best = better(whole[START], *whole[ASSISTANT]) if whole[START] else whole[ASSISTANT]
        out.append((best[0], str(best[1])))
    return out


def letter_counts(letters: str) -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated rows, and illegal neighbours."""
    classes = [INITIALS[(ord(x) - ord("A")) // 4] for x in letters]
    faults = [(ord(x) - ord("A")) % 4 for x in letters]
    illegal = sum(a + b not in LEGAL for a, b in zip(classes, classes[1:], strict=False))
    return faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), illegal


# --------------------------------------------------------------- in Spark --

def rows_of(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """The four columns, with one blank for a null role or text."""
    blank = F.lit(" ")
    return conversations.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                                F.coalesce(F.col(f"`{role_col}`"), blank).alias("role"),
                                F.coalesce(F.col(f"`{text_col}`"), blank).alias("text"))


def damage(rows: DataFrame) -> DataFrame:
    """The contract's faults, planted by the hash of id and turn."""
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(0), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1))
    return (rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
                        text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy"))


def _with_digest(rows: DataFrame) -> DataFrame:
    own = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.withColumn("digest", F.unhex(F.sha2(own, 256)))


def _stream(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], fields: dict[str, str]) -> DataFrame:
    schema = arrow_schema(fields)

    def run(batches):
        for out in fn(batches):
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return df.mapInArrow(run, ddl(fields))


def _id_type(rows: DataFrame) -> str:
    return dict(rows.dtypes)["conv_id"].replace("bigint", "long")


def letters(rows: DataFrame) -> DataFrame:
    """``(conv_id, letters)``: a letter for each row, in order."""
    initial = F.substring("role", 1, 1)
    klass = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    own = (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK)
           .when(F.col("text").rlike(r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*\z"), TRUNCATED).otherwise(0))
    narrow = materialize(_with_digest(rows).select("conv_id", "turn", "digest", (klass * 4 + own).alias("code")),
                         "conversation-rows")
    # a mark stands before the first row of each role and text
    marks = (narrow.groupBy("conv_id", "digest").agg(F.min(F.struct("turn")).alias("first"))
             .select("conv_id", F.col("first.turn").alias("turn"), "digest", F.lit(-1).alias("code")))
    order = ("conv_id", "turn", "digest")
    ordered = narrow.unionByName(marks).repartitionByRange(*order).sortWithinPartitions(*order, "code")
    fields = {"conv_id": _id_type(rows), "task": "int", "piece": "int", "letters": "string"}

    def run(batches):
        task, piece = TaskContext.get().partitionId(), 0
        conv, mark, held = None, None, []

        def out():
            return {"conv_id": [conv], "task": [task], "piece": [piece], "letters": ["".join(held)]}

        for batch in batches:
            for cid, turn, digest, code in zip(*(column(batch, n).to_pylist() for n in (*order, "code")), strict=True):
                if held and (cid != conv or len(held) >= PIECE):
                    yield out()
                    held, piece = [], piece + 1
                conv = cid
                if code < 0:
                    mark = (cid, turn, digest)
                    continue
                if code % 4 != BLANK:
                    if mark != (cid, turn, digest):
                        code += DUPLICATE - code % 4
                    mark = None
                held.append(chr(ord("A") + code))
        if held:
            yield out()

    pieces = _stream(ordered, run, fields)
    parts = F.sort_array(F.collect_list(F.struct("task", "piece", "letters")))
    return pieces.groupBy("conv_id").agg(F.array_join(F.transform(parts, lambda p: p["letters"]), "").alias("letters"))


def solutions(sequences: DataFrame) -> DataFrame:
    """Counts, cost and audit of each distinct value of ``letters``."""
    fields = {"letters": "string", "blank": "long", "duplicate": "long", "truncated": "long", "illegal": "long",
              "cost": "long", "audit": "string"}

    def make():
        def run(batch):
            each = column(batch, "letters").to_pylist()
            rows = [(s, *letter_counts(s), *found) for s, found in zip(each, solve(each), strict=True)]
            return {name: [r[k] for r in rows] for k, name in enumerate(fields)}
        return run

    return map_batches(sequences.select("letters").distinct(), make, fields, rows=SOLVE_ROWS)


def repair_report(rows: DataFrame) -> DataFrame:
    """One row per conversation with rows: ``gaps``, the counts of faults,
    ``illegal``, ``cost`` and ``audit``."""
    found = letters(rows)
    found = materialize(found.join(solutions(found), "letters").drop("letters"), "conversation-audits")
    gaps = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    found = found.withColumnRenamed("conv_id", "_id")
    return gaps.join(found, gaps["conv_id"].eqNullSafe(found["_id"])).drop("_id")


def repaired_rows(rows: DataFrame, report: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``position`` from 0, ``role``,
    ``text`` and ``edit`` (K kept, R new role, I inserted).  A conversation's
    rows are in one partition, in order."""
    audits = report.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("digest"),
                           F.lit(0).alias("is_row"), F.lit(None).cast("string").alias("role"),
                           F.col("audit").alias("text"))
    given = _with_digest(rows).select("conv_id", F.col("turn").cast("long").alias("turn"), "digest",
                                      F.lit(1).alias("is_row"), "role", "text")
    order = ("conv_id", "is_row", "turn", "digest")
    ordered = given.unionByName(audits).repartition("conv_id").sortWithinPartitions(*order)
    fields = {"conv_id": _id_type(rows), "position": "long", "role": "string", "text": "string", "edit": "string"}

    def run(batches):
        out, chars = {n: [] for n in fields}, 0
        conv, audit, at, position, state = None, "", 0, 0, START

        def put(role, text, edit):
            nonlocal position, state, chars
            if edit != "K":
                state = ASSISTANT if state == USER else USER
                role = ROLES[state]
            else:
                state = FOLLOWS[role[0]][state]
            for name, cell in zip(fields, (conv, position, role, text, edit), strict=True):
                out[name].append(cell)
            position, chars = position + 1, chars + len(text)

        def put_inserts():
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                put("", "", "I")
                at += 1

        for batch in batches:
            names = ("conv_id", "is_row", "role", "text")
            for cid, is_row, role, text in zip(*(column(batch, n) for n in names), strict=True):
                if not is_row.as_py():
                    conv, audit, at, position, state = cid.as_py(), text.as_py(), 0, 0, START
                else:
                    edit, at = audit[at], at + 1
                    if edit != "D":
                        put(role.as_py(), text.as_py(), edit)
                put_inserts()
                if len(out["text"]) >= BATCH_ROWS or chars >= BATCH_CHARS:
                    yield out
                    out, chars = {n: [] for n in fields}, 0
        yield out

    return _stream(ordered, run, fields)


def text_digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of each repaired conversation as lines of ``role:text``, read in
    the order and partitions of ``repaired_rows``."""
    fields = {"conv_id": _id_type(repaired), "sha256": "string"}

    def run(batches):
        conv, digest = None, None
        for batch in batches:
            done: dict[str, list] = {n: [] for n in fields}
            names = ("conv_id", "position", "role", "text")
            for cid, position, role, text in zip(*(column(batch, n).to_pylist() for n in names), strict=True):
                if position == 0:
                    if digest:
                        done["conv_id"].append(conv)
                        done["sha256"].append(digest.hexdigest())
                    conv, digest = cid, hashlib.sha256()
                digest.update(f"{role}:{text}".encode() if position == 0 else f"\n{role}:{text}".encode())
            yield done
        if digest:
            yield {"conv_id": [conv], "sha256": [digest.hexdigest()]}

    return _stream(repaired, run, fields)
