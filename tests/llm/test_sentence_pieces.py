"""Encoding and decoding against the library on whole texts."""

import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import sentence_pieces as S
from ledgerlens.llm.queries import queries

from .helpers import SF_SMALL, awkward_rows, documents, prose

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TABLE = S.ChunkTable(MODEL)


def check(text, table=TABLE):
    ids, decoded = table.encode(text)
    expected = table.model.encode(text)
    assert ids.tolist() == expected
    assert decoded == table.model.decode(expected)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" ▁ab\n\t<>s/é漢\U0001f642\x00　ﬁ."), st.characters(codec="utf-8"))))
def test_any_text_as_the_library(text):
    check(text)


@pytest.mark.parametrize("text", ["", " ", "  ", "a ", " a", "a  b   c    ", "▁", "a▁▁b", "<s> </s> <unk> <0x41>",
                                  "x" * 5000, "漢字" * 3000, " " * 4000, "\n \n  \n", "a\x00b \x00", "﻿a", "é ́"])
def test_edge_texts(text):
    check(text)


def test_windows_hold_whole_chunks(monkeypatch):
    text = "  " + prose(5, 3000) + "   end  "
    text = text.replace("an", "\nan")
    for size in (1, 7, 1000):
        parts = list(S.windows(text, size))
        assert "".join(c for p in parts for c in p) == " " + text
        assert all(c[0] in " \n" for p in parts for c in p)
        assert [c for p in parts for c in p] == [c for p in S.windows(text) for c in p]
    monkeypatch.setattr(S, "WINDOW_CHARS", 50)
    monkeypatch.setattr(S, "TABLE_CHUNKS", 20)  # the table starts anew many times
    check(text, S.ChunkTable(MODEL))


def test_each_chunk_is_segmented_once():
    table, seen = S.ChunkTable(MODEL), []
    real = table.model

    class Spy:
        def encode(self, chunks, **kw):
            seen.extend(chunks)
            return real.encode(chunks, **kw)

        def __getattr__(self, name):
            return getattr(real, name)

    table.model = Spy()
    for text in ("one two one", "two three", "one  three"):
        table.encode(text)
    assert sorted(seen) == [" three", "one", "three", "two"]


def test_awkward_rows(spark):
    got = sorted((str(r.doc_id), tuple(r.ids), r.decoded) for r in S.encode_documents(documents(spark), MODEL).collect())
    expected = sorted((str(i), tuple(TABLE.model.encode(t or "")), TABLE.model.decode(TABLE.model.encode(t or "")))
                      for i, t, *_ in awkward_rows())
    assert got == expected
    assert S.encode_documents(documents(spark, []), MODEL).count() == 0


def test_models_that_cannot_be_cut_are_refused(monkeypatch):
    import sentencepiece

    class Crossing(sentencepiece.SentencePieceProcessor):
        def id_to_piece(self, i):
            return "a▁b" if i == 5 else super().id_to_piece(i)

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Crossing)
    with pytest.raises(ValueError, match="across"):
        S.ChunkTable(MODEL)


def test_query_matches_the_library(spark):
    got = {r.doc_id: r for r in queries()["op13_sentence_pieces"](spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    for doc_id, text in docs:
        ids = TABLE.model.encode(text or "")
        row = got[doc_id]
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (
            len(ids), sha(",".join(map(str, ids))), sha(TABLE.model.decode(ids)))
