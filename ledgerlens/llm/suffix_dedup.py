"""Removal of every byte covered by a long string that occurs more than once.

Suffixes are compared to their first ``length`` bytes and sorted blockwise, one
bucket at a time, in bounded memory.  A difference cover keeps the work small:
the positions whose number modulo the period is in the cover are the sample,
and of any two suffixes there is a shift, below the period, that puts both on
sample positions.  So two suffixes can tie over ``length`` bytes only if the
samples in their first period tie as well:

1. the cover sample is ranked first: sample strings are sorted bucket by bucket
   and those that occur only once are told;
2. a suffix with no sample string in its first period that occurs again cannot
   have a long tie; only the others are sorted, bucket by bucket.

Strings are ordered by 64-bit fingerprints, not by their bytes, because only
ties matter here; sample ranks use 32 bits besides the bucket, as a false tie
among them only lets a suffix pass to the exact step.  With n suffixes left for
sorting, the odds of any false tie are about n^2 / 2^65.

Long copies would fill the buckets with suffixes that all tie, so texts are
also cut at places that their own bytes choose.  Where a whole cut piece (with
the ``length - 1`` bytes behind it) occurs twice, all its suffixes tie, and
just one copy of it is sorted, for the suffixes of other pieces to meet.

Documents are gathered into blocks that are written once.  A block sends each
of its different keys once to the key's bucket and gets one bit a key back, so
a string that is everywhere costs a bucket one key a block.  Fingerprints are
computed anew from the block at each step rather than kept.

Defined cases: null and empty texts have no bytes and the digest of nothing; a
null id passes through; repeated rows are documents of their own and remove
each other's strings; texts shorter than ``length`` lose nothing; an empty
table gives an empty result; columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import whole_groups
from .common import arrow_schema, column, ddl, id_text, materialize, shuffle_partitions

LENGTH = 400
BLOCK_BYTES = 1 << 18       # text of a block, unless one document is longer
BUCKET_BYTES = 1 << 24      # text for each bucket of keys
CUT_BYTES, CUT_EVERY = 24, 512
SAMPLE, PIECE, SUFFIX = 0, 1, 2   # kinds of keys


def difference_cover(r: int = 2) -> tuple[int, np.ndarray]:
    """Period and members of a cover by Colbourn and Ling's rule: every
    difference modulo the period is one of two members."""
    gaps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return 24 * r * r + 36 * r + 13, np.r_[0, np.cumsum(gaps)]


PERIOD, COVER = difference_cover()
_BYTE = np.random.default_rng(42).integers(0, 1 << 64, 256, np.uint64)
_UP = 0x9E3779B97F4A7C15
_DOWN = pow(_UP, -1, 1 << 64)


class Powers:
    """Powers of the fingerprint's base and of its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            def series(base):
                out = np.full(n + n // 4, base, np.uint64)
                out[0] = 1
                return np.cumprod(out)
            self.up, self.down = series(_UP), series(_DOWN)
        return self.up, self.down


class Block:
    """Fingerprints of a run of documents.  Positions are those of the block;
    strings never leave their document."""

    def __init__(self, body: bytes, lengths: list[int], powers: Powers, length: int):
        self.body = np.frombuffer(body, np.uint8)
        self.lengths, self.length, n = np.asarray(lengths, np.int64), length, len(body)
        self.end = np.cumsum(self.lengths)
        self.end_of = np.repeat(self.end, self.lengths)
        self.up, down = powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.body] * down[:n], out=self.sums[1:])
        self.suffixes = np.flatnonzero(np.arange(n) + length <= self.end_of)

    def keys(self, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Fingerprints of the strings from ``at`` to ``end``."""
        h = (self.sums[end] - self.sums[at]) * self.up[at]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))

    def sample(self) -> tuple[np.ndarray, np.ndarray]:
        """Cover positions, and the fingerprints of their strings."""
        size, n = self.length - PERIOD + 1, len(self.body)
        at = (np.arange(0, n, PERIOD)[:, None] + COVER[None]).ravel()
        at = at[at < n]
        at = at[at + size <= self.end_of[at]]
        return at, self.keys(at, at + size)

    def pieces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First suffix of each piece, the end of its suffixes (as positions in
        ``suffixes``), and the fingerprint of the piece with the bytes behind."""
        s = self.suffixes
        if not len(s):
            return s, s, np.zeros(0, np.uint64)
        cut = self.keys(s, s + CUT_BYTES) % np.uint64(CUT_EVERY) == 0
        cut[np.r_[True, s[1:] != s[:-1] + 1]] = True
        first = np.flatnonzero(cut)
        last = np.r_[first[1:], len(s)]
        size = (last - first).astype(np.uint64)
        return first, last, self.keys(s[first], s[last - 1] + self.length) ^ (size * np.uint64(_UP))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are equal ranges of keys, so sorted keys are sorted by bucket."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def by_bucket(kind: int, keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Sorted different keys, split by bucket."""
    own = bucket_of(keys, buckets)
    cuts = np.r_[0, np.flatnonzero(own[1:] != own[:-1]) + 1, len(own)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield (kind << 40) | int(own[a]), keys[a:b]


class Replies:
    """Bits that the buckets sent back, in the order of a block's sorted keys."""

    def __init__(self, cells: list[dict] | None):
        self.bits: dict[int, list[tuple[int, bytes]]] = {SAMPLE: [], PIECE: [], SUFFIX: []}
        for c in sorted(cells or [], key=lambda c: c["slot"]):
            self.bits[c["slot"] >> 40].append((c["n"], c["bits"]))

    def of(self, kind: int, which: int = 0) -> np.ndarray:
        parts = [np.unpackbits(np.frombuffer(b, np.uint8))[which * n:(which + 1) * n] for n, b in self.bits[kind]]
        return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


class Ties:
    """What is known of a block's suffixes after the sample's ranking."""

    def __init__(self, block: Block, replies: Replies):
        self.block, s, n = block, block.suffixes, len(block.body)
        at, keys = block.sample()
        different, place, count = np.unique(keys, return_inverse=True, return_counts=True)
        again = replies.of(SAMPLE) | (count > 1) if len(different) else np.zeros(0, bool)
        seen = np.zeros(n + PERIOD + 1, np.int64)
        seen[at[again[place]] + 1] = 1
        seen = np.cumsum(seen)
        self.may_tie = seen[s + PERIOD] > seen[s]
        first, last, keys = block.pieces()
        different, start, place, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        shared = replies.of(PIECE) if len(different) else np.zeros(0, bool)
        leads = replies.of(PIECE, 1) if len(different) else np.zeros(0, bool)
        twice = shared | (count > 1)
        chosen = np.zeros(len(keys), bool)   # the copies of pieces that are sorted
        chosen[start[twice & (leads | ~shared)]] = True
        self.in_copy = np.repeat(twice[place], last - first)
        self.sorted = self.may_tie & (~self.in_copy | np.repeat(chosen, last - first))
        self.keys, self.place, self.count = np.unique(
            block.keys(s[self.sorted], s[self.sorted] + block.length), return_inverse=True, return_counts=True)

    def tied(self, replies: Replies) -> np.ndarray:
        """The positions of suffixes whose first ``length`` bytes occur again."""
        out = self.in_copy.copy()
        again = replies.of(SUFFIX) | (self.count > 1) if len(self.keys) else np.zeros(0, bool)
        out[np.flatnonzero(self.sorted)[again[self.place]]] = True
        return self.block.suffixes[out]


def gather(docs: DataFrame) -> DataFrame:
    """Blocks of documents: ids, lengths in bytes, and the bytes compressed."""
    fields = {"block": "long", "ids": "array<long>", "lengths": "array<long>", "body": "binary"}
    schema = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, press = TaskContext.get().partitionId(), 0, zstandard.ZstdCompressor(level=1)
        ids, parts, size = [], [], 0

        def block():
            return pa.RecordBatch.from_pydict({
                "block": [(part << 32) + number], "ids": [ids], "lengths": [[len(p) for p in parts]],
                "body": [press.compress(b"".join(parts))]}, schema=schema)

        for batch in batches:
            for doc, text in zip(column(batch, "doc_id"), column(batch, "text"), strict=True):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                ids.append(doc.as_py())
                parts.append(raw)
                size += len(raw)
                if size >= BLOCK_BYTES:
                    yield block()
                    ids, parts, size, number = [], [], 0, number + 1
        if ids:
            yield block()

    return docs.mapInArrow(run, ddl(fields))


KEYS = {"slot": "long", "block": "long", "n": "long", "keys": "binary"}
BITS = {"block": "long", "slot": "long", "n": "long", "bits": "binary"}


def _blocks(batch: pa.RecordBatch, powers: Powers, length: int) -> Iterator[tuple[dict, bytes, Block]]:
    for i in range(batch.num_rows):
        row = batch.slice(i, 1).to_pylist()[0]
        body = zstandard.ZstdDecompressor().decompress(row["body"]) if sum(row["lengths"]) else b""
        yield row, body, Block(body, row["lengths"], powers, length)


def send_keys(find, length: int):
    """The task that sends a block's different keys to their buckets.  ``find``
    yields, from a row and its block, kinds and sorted keys."""
    schema = arrow_schema(KEYS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for row, _, block in _blocks(batch, powers, length):
                out = {k: [] for k in KEYS}
                for slot, keys in find(row, block):
                    for k, v in zip(KEYS, (slot, row["block"], len(keys), keys.tobytes()), strict=True):
                        out[k].append(v)
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    return run


def rank_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task that sorts buckets, one at a time.  For each key of each block:
    does another block have it, and is this the first block that has it?"""
    schema = arrow_schema(BITS)
    for t in whole_groups(batches, "slot", 1):
        slots = t["slot"].to_numpy()
        cuts = np.r_[0, np.flatnonzero(slots[1:] != slots[:-1]) + 1, len(slots)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b == a:
                continue
            own, n = t.slice(a, b - a), t["n"].to_numpy()[a:b]
            kind = np.uint32 if slots[a] >> 40 == SAMPLE else np.uint64
            keys = np.concatenate([np.frombuffer(k.as_py(), kind) for k in own["keys"]])
            order = np.argsort(keys, kind="stable")   # rows are in order of blocks
            ordered = keys[order]
            same = ordered[1:] == ordered[:-1]
            shared, leads = np.zeros(len(keys), np.uint8), np.zeros(len(keys), np.uint8)
            shared[order] = np.r_[same, False] | np.r_[False, same]
            leads[order] = ~np.r_[False, same]
            ends = np.cumsum(n)
            bits = [np.packbits(np.r_[shared[z - m:z], leads[z - m:z]] if slots[a] >> 40 == PIECE else shared[z - m:z])
                    .tobytes() for z, m in zip(ends, n, strict=True)]
            yield pa.RecordBatch.from_arrays([own["block"].combine_chunks(), own["slot"].combine_chunks(),
                                              own["n"].combine_chunks(), pa.array(bits, pa.binary())], schema=schema)


def ask_buckets(sent: DataFrame, parts: int, name: str) -> DataFrame:
    """``(block, replies)``: what the buckets say of each block's keys."""
    bits = materialize(sent.repartition(parts, "slot").sortWithinPartitions("slot", "block")
                       .mapInArrow(rank_buckets, ddl(BITS)), name)
    return bits.groupBy("block").agg(F.collect_list(F.struct("slot", "n", "bits")).alias("replies"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   keep_text: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans,
    kept_sha256``, and with ``keep_text`` the bytes left, ``kept``."""
    if length < PERIOD + CUT_BYTES:
        raise ValueError(f"length must be at least {PERIOD + CUT_BYTES}")
    spark = docs.sparkSession
    blocks = materialize(gather(id_text(docs, id_col, text_col)), "suffix-blocks")
    total = blocks.select(F.expr("aggregate(lengths, 0L, (a, x) -> a + x)").alias("n")).agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    parts = shuffle_partitions(spark)

    def of_sample(row: dict, block: Block):
        for slot, keys in by_bucket(SAMPLE, np.unique(block.sample()[1]), buckets):
            yield slot, keys.astype(np.uint32)
        yield from by_bucket(PIECE, np.unique(block.pieces()[2]), buckets)

    def of_suffixes(row: dict, block: Block):
        yield from by_bucket(SUFFIX, Ties(block, Replies(row["replies"])).keys, buckets)

    ranks = ask_buckets(blocks.mapInArrow(send_keys(of_sample, length), ddl(KEYS)), parts, "suffix-ranks")
    ranked = blocks.join(ranks, "block", "left")
    ties = ask_buckets(ranked.mapInArrow(send_keys(of_suffixes, length), ddl(KEYS)), parts, "suffix-ties")
    fields = {"doc_id": "long", "n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept_sha256": "string"}
    fields |= {"kept": "binary"} if keep_text else {}
    schema = arrow_schema(fields)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for row, body, block in _blocks(batch, powers, length):
                at = Ties(block, Replies(row["replies"])).tied(Replies(row["more"]))
                edge = np.bincount(at, minlength=len(body) + 1) - np.bincount(at + length, minlength=len(body) + 1)
                gone = np.cumsum(edge[:-1]) > 0
                out = {k: [] for k in fields}
                for doc, z, n in zip(row["ids"], block.end, row["lengths"], strict=True):
                    own = gone[z - n:z]
                    kept = block.body[z - n:z][~own].tobytes()
                    spans = int(own[:1].sum() + (own[1:] & ~own[:-1]).sum())
                    cells = (doc, n, int(own.sum()), spans, hashlib.sha256(kept).hexdigest(), kept)
                    for k, v in zip(fields, cells, strict=False):
                        out[k].append(v)
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    both = ranked.join(ties.withColumnRenamed("replies", "more"), "block", "left")
    return both.mapInArrow(finish, ddl(fields))
