"""SentencePiece encoding and decoding through a table of distinct chunks.

The model writes a blank as a marker and puts one before the text.  Where no
piece of its vocabulary has a marker after another character, no merge reaches
across the place before a run of markers, so a text's pieces are those of its
chunks (blanks and the characters after them) one after another; the same holds
before a line feed where no piece has one beside other characters.  Each task
keeps a table chunk -> ids and chunk -> decoded text: the library segments a
chunk once, and the ids of a text are gathered from the table by the positions
of its chunks.  The table starts anew when it holds ``TABLE_CHUNKS`` chunks or
``TABLE_CHARS`` characters, which costs time only.

Nothing is shuffled: joining every chunk of a corpus to one common table would
move more than the texts themselves, and a chunk costs a task one segmentation.

A chunk's decoded text is its pieces side by side; chunks with byte pieces are
decoded by the library.  A model that rewrites texts (other than blanks), drops
blanks, or has pieces across those places cannot be cut and is refused.

Defined cases: null and empty texts have no ids and decode to the empty text;
a marker character in a text counts as a blank, as in the library; a null id
passes through; repeated rows are encoded one by one; an empty table gives an
empty result; long texts are cut into windows of whole chunks, and a chunk of
any length is segmented whole; columns other than id and text are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import column, id_text, map_batches, texts

MARK = "▁"
TABLE_CHUNKS = 500_000
TABLE_CHARS = 10_000_000
WINDOW_CHARS = 1_000_000   # of a text whose chunks are held as objects at one time
_CHUNK = re.compile("(?: +|\n)[^ \n]*")
_CUT = re.compile("(?<! ) ")
# a ligature, a wide blank and doubled blanks: what normalisation would change
_PROBE = "ﬁ  a　b "


class ChunkTable:
    """Distinct chunks with their ids and decoded texts."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces):
            raise ValueError("the model has pieces across whitespace markers or line feeds")
        # pieces that stand for themselves; a chunk with others is decoded by the library
        self.texts = {i: p.replace(MARK, " ") for i, p in enumerate(pieces) if not (
            self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i))}
        if self.model.normalize(_PROBE) != MARK + _PROBE.replace(" ", MARK):
            raise ValueError("the model rewrites texts before it segments them")
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.decoded: list[str] = []
        self.flat, self.starts, self.sizes = array("i"), array("q"), array("q")
        self.chars = 0

    def learn(self, chunks: set[str]) -> None:
        """Segment the chunks that the table does not have yet."""
        fresh = [c for c in chunks if c not in self.places]
        # the library puts a marker first, which stands for the first blank of a
        # chunk and before a line feed is a piece too many; alone it is a piece
        ids = self.model.encode([c if c[0] == "\n" else c[1:] for c in fresh], num_threads=1)
        alone = self.model.piece_to_id(MARK)
        for c, own in zip(fresh, ids, strict=True):
            own = own[1:] if c[0] == "\n" else own or [alone]
            try:
                text = "".join(map(self.texts.__getitem__, own))
            except KeyError:
                # the library takes one marker off the first piece
                text = self.model.decode([alone, *own])
            self.places[c] = len(self.decoded)
            self.decoded.append(c if text == c else text)
            self.starts.append(len(self.flat))
            self.sizes.append(len(own))
            self.flat.extend(own)
            self.chars += len(c)

    def encode(self, text: str) -> tuple[np.ndarray, str]:
        """Ids and decoded text."""
        ids, decoded = [np.zeros(0, np.int32)], []
        for chunks in windows(text):
            if len(self.decoded) > TABLE_CHUNKS or self.chars > TABLE_CHARS:
                self.clear()
            try:
                at = np.fromiter(map(self.places.__getitem__, chunks), np.int64, len(chunks))
            except KeyError:
                self.learn(set(chunks))
                at = np.fromiter(map(self.places.__getitem__, chunks), np.int64, len(chunks))
            decoded.extend(map(self.decoded.__getitem__, at.tolist()))
            starts, sizes = (np.frombuffer(a, np.int64)[at] for a in (self.starts, self.sizes))
            ends = np.cumsum(sizes)
            ids.append(np.frombuffer(self.flat, np.int32)[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])])
        return np.concatenate(ids), "".join(decoded)[1:]


def windows(text: str, size: int = WINDOW_CHARS) -> Iterator[list[str]]:
    """The chunks of a text, as lists of about ``size`` characters."""
    if not text:
        return
    marked, at = " " + text.replace(MARK, " "), 0
    while at < len(marked):
        cut = _CUT.search(marked, at + size)
        end = cut.start() if cut else len(marked)
        yield _CHUNK.findall(marked, at, end)
        at = end


def encode_documents(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` without begin or end ids, and ``decoded``, the text
    that the library makes of those ids."""
    docs = id_text(docs, id_col, text_col)
    fields = {"doc_id": dict(docs.dtypes)["doc_id"].replace("bigint", "long"), "ids": "array<int>", "decoded": "string"}

    def make():
        table = ChunkTable(model_file)

        def run(batch):
            rows = [table.encode(t) for t in texts(batch)]
            ends = np.cumsum([0, *(len(ids) for ids, _ in rows)])
            flat = np.concatenate([ids for ids, _ in rows]) if rows else np.zeros(0, np.int32)
            return {"doc_id": column(batch, "doc_id"),
                    "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
                    "decoded": [text for _, text in rows]}
        return run

    return map_batches(docs, make, fields)
