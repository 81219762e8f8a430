"""Packing token sequences by vector bin packing.

Every piece of text has a demand in several dimensions: tokens, segments (one
each) and loss-bearing tokens; a sequence has a limit in each.  A sequence is
filled by repeatedly taking, of the pieces that still fit in every dimension,
the one whose demand has the largest dot product with what is left of the
limits, each dimension as a share of its limit.

Documents are tokenized, closed with an end token and cut into pieces of at
most a sequence; pieces are dealt evenly into groups of bounded size, and each
group is packed by one task, so padding comes only from the last sequences of
a group.  The deal is by position in a written table: repeated rows spread out
and a lost task packs the same pieces again.

Defined cases: null and empty texts are the end token alone; a null id passes
through; repeated rows are packed one by one; a piece that alone passes a limit
gets a sequence of its own; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, column, ddl, map_batches, materialize, shuffle_partitions, texts

END_ID = 1
LENGTH = 2048
SEGMENTS = 128
GROUP = 4096            # pieces that are packed together

# Fixed value: the vocabulary's first step, how a text is cut before its merges.
CUT = (r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s")


class Encoder:
    """Token ids, as little-endian unsigned 32-bit bytes, of whole texts.

    The ids are those of ``tokenizers`` with the vocabulary file.  That library
    is several times slower on long texts than ``tiktoken``, which gets the
    same vocabulary (a token's id is its rank among the merges) and encodes the
    texts of Latin script; texts with other characters, whose classes could
    differ between the two libraries, and texts that hold an added token's
    string go to ``tokenizers``.  One text of each batch is encoded by both;
    after a difference all texts go to ``tokenizers``."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        byte_of = _bytes_of_letters()
        ranks = {bytes(byte_of[c] for c in t): i for t, i in self.tokenizer.get_vocab().items() if t not in special}
        self.beyond = re.compile("|".join(["[^\x00-\u024f]", *map(re.escape, sorted(special))]))
        self.agree = True
        self.fast = tiktoken.Encoding("packing", pat_str=CUT, mergeable_ranks=ranks, special_tokens={})

    def reference(self, tx: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(tx, add_special_tokens=False)]

    def __call__(self, tx: list[str]) -> list[bytes]:
        latin = [self.agree and not self.beyond.search(t) for t in tx]
        rest = iter(self.reference([t for t, fast in zip(tx, latin, strict=True) if not fast]))
        out = [np.array(self.fast.encode_ordinary(t), "<u4").tobytes() if fast else next(rest)
               for t, fast in zip(tx, latin, strict=True)]
        if any(latin):
            k = min((k for k, fast in enumerate(latin) if fast), key=lambda k: abs(len(tx[k]) - 1000))
            if self.reference([tx[k]])[0] != out[k]:
                self.agree = False
                return self.reference(tx)
        return out


def _bytes_of_letters() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a letter: printable ones as
    themselves, the others in order as the letters from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def pieces(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, id_col: str = "doc_id",
           text_col: str = "text", prompt_col: str | None = None) -> DataFrame:
    """Tokenize and cut: one row per piece.  A piece's first token bears no
    loss, as nothing in its sequence predicts it; nor do the first tokens of a
    document, as many as ``prompt_col`` says (instruction data; null: none)."""
    prompt = F.lit(0) if prompt_col is None else F.coalesce(F.col(f"`{prompt_col}`"), F.lit(0))
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                       prompt.cast("long").alias("prompt"))
    fields = {"doc_id": dict(docs.dtypes)["doc_id"].replace("bigint", "long"), "start": "long", "length": "long",
              "loss_tokens": "long", "ids_crc32": "long", "doc_tokens": "long"}

    def make():
        encode, end = Encoder(tokenizer_path), np.array([END_ID], "<u4").tobytes()

        def run(batch):
            out = {k: [] for k in fields}
            for doc, ids, prompt in zip(column(batch, "doc_id").to_pylist(), encode(texts(batch)),
                                        column(batch, "prompt").to_pylist(), strict=True):
                ids += end
                n = len(ids) // 4
                for at in range(0, n, length):
                    part = ids[4 * at:4 * (at + length)]
                    m = len(part) // 4
                    for k, v in zip(fields, (doc, at, m, max(0, m - max(1, prompt - at)), zlib.crc32(part), n), strict=True):
                        out[k].append(v)
            return out
        return run

    return map_batches(docs, make, fields)


def _best_fit(share: np.ndarray, places: np.ndarray, rest: np.ndarray, room: np.ndarray, top: np.ndarray,
              step: int = 512) -> int | None:
    """Of ``rest``, indices of ``places``, the first with the largest dot product
    among those that fit.  They are looked at step by step, until what the
    others may ask for at most (``top``, by place) cannot beat the best found."""
    best, pick, room_left = -1.0, None, np.maximum(room, 0)
    for at in range(0, len(rest), step):
        if pick is not None and float(top[places[rest[at]]] @ room_left) <= best:
            break
        some = rest[at:at + step]
        some = some[(share[places[some]] <= room + 1e-12).all(1)]
        if len(some):
            dots = share[places[some]] @ room_left
            k = int(np.argmax(dots))
            if dots[k] > best:
                best, pick = float(dots[k]), int(some[k])
    return pick


def pack_group(demand: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and place in it of each piece, given the pieces' demands
    (one row each), of which the first column is tokens."""
    order, n = np.argsort(-demand[:, 0], kind="stable"), len(demand)
    tokens, share = demand[order, 0], (demand / limits)[order]
    # the most that a piece from some place of this order on asks of each dimension
    top = np.maximum.accumulate(share[::-1], axis=0)[::-1]
    sequence, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    left, number = np.arange(n), 0
    while len(left):
        room, used, at = np.ones(share.shape[1]), np.zeros(len(left), bool), 0
        pick = 0  # the largest piece opens a sequence, whatever its demand
        while pick is not None:
            place = left[pick]
            sequence[order[place]], offset[order[place]] = number, at
            at += tokens[place]
            room = room - share[place]
            used[pick] = True
            # none before this one has as few tokens as fit
            low = int(np.searchsorted(-tokens[left], -(room[0] + 1e-12) * limits[0])) if room[0] > 0 else len(left)
            pick = _best_fit(share, left, np.flatnonzero(~used[low:]) + low, room, top)
        left = left[~used]
        number += 1
    return sequence, offset


def pack(items: DataFrame, limits: dict[str, int], group: int = GROUP) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table of pieces.
    ``limits`` names the demand columns, tokens first; a limit on ``segments``
    counts pieces."""
    spark = items.sparkSession
    groups = max(1, -(-items.count() // group))
    kept = dict(items.dtypes)
    fields = {n: t.replace("bigint", "long") for n, t in kept.items()} | {"sequence_id": "long", "offset": "long"}
    schema, most = arrow_schema(fields), np.array(list(limits.values()), float)
    dealt = items.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(t: pa.Table) -> Iterator[pa.RecordBatch]:
            demand = np.column_stack([np.ones(t.num_rows) if k == "segments" else t[k].to_numpy().astype(float)
                                      for k in limits])
            sequence, offset = pack_group(demand, most)
            number = (t["group"][0].as_py() << 32) + sequence
            t = t.drop(["group"]).append_column("sequence_id", pa.array(number)).append_column(
                "offset", pa.array(offset))
            yield from t.cast(schema).to_batches(1 << 14)

        held: list[pa.RecordBatch] = []
        for b in batches:
            g = column(b, "group").to_numpy()
            cuts = np.r_[0, np.flatnonzero(g[1:] != g[:-1]) + 1, len(g)]
            for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                if held and column(held[0], "group")[0].as_py() != g[a]:
                    yield from packed(pa.Table.from_batches(held))
                    held = []
                if z > a:
                    held.append(b.slice(a, z - a))
        if held:
            yield from packed(pa.Table.from_batches(held))

    order = ["group", *kept]
    return (dealt.repartition(min(groups, shuffle_partitions(spark)), "group").sortWithinPartitions(*order)
            .mapInArrow(run, ddl(fields)))


def pack_documents(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, segments: int = SEGMENTS,
                   id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None,
                   loss_tokens: int | None = None) -> DataFrame:
    """Pieces of the documents with the sequence and the offset of each.  A
    sequence holds at most ``loss_tokens`` tokens that bear loss (by default as
    many as it can)."""
    cut = materialize(pieces(docs, tokenizer_path, length, id_col, text_col, prompt_col), "packing-pieces")
    return pack(cut, {"length": length, "segments": segments,
                      "loss_tokens": length - 1 if loss_tokens is None else loss_tokens})
