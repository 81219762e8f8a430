"""License scan by template-markup matching.

A template is a license text in markup: plain words are mandatory,
``<<optional>> ... <<end>>`` encloses words that may be left out together (and
may be nested), and ``<<var max=N>>`` stands for up to N words of any kind.
Each template is compiled into a token automaton; a text is accepted where the
automaton runs from its first to its last state over consecutive words, so all
mandatory wording must match exactly.  Texts are matched anywhere in a
document.  The base phrases are found besides, wherever their words stand
consecutively.

Words are maximal runs of characters other than ASCII blanks, controls and
punctuation, with A-Z in lower case.

Defined cases: null and empty texts have no words, labels or places and score
0; a null id passes through; repeated rows are scanned one by one; an empty
table gives an empty result; texts are read whole; columns other than id and
text are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

from .common import column, id_text, map_batches, texts

# Phrases of the contract with their labels.
BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Wording of public licenses and of their notices.
TEMPLATES = {
    "apache-2.0": """
        licensed under the <<optional>>terms of the<<end>> apache license <<optional>>version<<end>> 2 0""",
    "apache-2.0-notice": """
        licensed under the apache license version 2 0 the license you may not use this
        <<var max=4>> except in compliance with the license you may obtain a copy of the license at <<var max=8>>
        unless required by applicable law or agreed to in writing software distributed under the license is
        distributed on an as is basis without warranties or conditions of any kind either express or implied""",
    "mit": """
        <<optional>>released<<end>><<optional>>licensed<<end>> under the <<optional>>terms of the<<end>> mit license""",
    "mit-text": """
        permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files the software to deal in the software without restriction including without limitation
        the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to
        permit persons to whom the software is furnished to do so subject to the following conditions
        the above copyright notice and this permission notice <<optional>>including the next paragraph<<end>>
        shall be included in all copies or substantial portions of the software""",
    "isc": """
        permission to use copy modify and or distribute this software for any purpose with or without fee is hereby
        granted provided that the above copyright notice and this permission notice appear in all copies""",
    "bsd-2-clause": """
        redistribution and use in source and binary forms with or without modification are permitted provided that
        the following conditions are met <<optional>>1<<end>> redistributions of source code must retain the above
        copyright notice this list of conditions and the following disclaimer <<optional>>2<<end>> redistributions
        in binary form must reproduce the above copyright notice this list of conditions and the following
        disclaimer in the documentation and or other materials provided with the distribution""",
    "bsd-3-clause": """
        redistribution and use in source and binary forms with or without modification are permitted provided that
        the following conditions are met <<optional>>1<<end>> redistributions of source code must retain the above
        copyright notice this list of conditions and the following disclaimer <<optional>>2<<end>> redistributions
        in binary form must reproduce the above copyright notice this list of conditions and the following
        disclaimer in the documentation and or other materials provided with the distribution <<optional>>3<<end>>
        neither the name of <<var max=12>> nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission""",
    "gpl-2.0-or-later": """
        it under the terms of the gnu general public license as published by the free software foundation either
        version 2 of the license or at your option any later version""",
    "gpl-3.0": """
        licensed under the <<optional>>terms of the<<end>> gnu general public license
        <<optional>>as published by the free software foundation<<end>> version 3 <<optional>>0<<end>>""",
    "gpl-3.0-or-later": """
        it under the terms of the gnu general public license as published by the free software foundation either
        version 3 of the license or at your option any later version""",
    "cc-by-4.0": """
        licensed under <<optional>>a<<end>><<optional>>the<<end>> <<optional>>creative commons<<end>>
        <<optional>>cc by<<end>> <<optional>>attribution<<end>> 4 0 <<optional>>international<<end>> license""",
    "public-domain": """
        this is free and unencumbered software released into the public domain""",
}

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
              for c in range(256))
_MARKUP = re.compile(r"<<optional>>|<<end>>|<<var max=(\d+)>>|[^\s<]+")


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


@dataclass(frozen=True)
class Automaton:
    """``on[s]`` maps a word to the next state, ``any[s]`` is the next state on
    any word, ``skip[s]`` are states reached without a word."""

    label: str
    on: tuple[dict[bytes, int], ...]
    any: tuple[int | None, ...]
    skip: tuple[frozenset[int], ...]
    anchor: tuple[bytes, ...]      # the longest run of mandatory words

    def closed(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for t in self.skip[todo.pop()] - out:
                out.add(t)
                todo.append(t)
        return out

    def longest(self, words: list[bytes], start: int) -> int | None:
        """End of the longest accepted run of words from ``start``."""
        states, last, end = self.closed({0}), len(self.on) - 1, None
        for t in range(start, len(words) + 1):
            if last in states and t > start:
                end = t
            if t == len(words):
                break
            moved = {self.on[s][words[t]] for s in states if words[t] in self.on[s]}
            moved |= {self.any[s] for s in states if self.any[s] is not None}
            if not moved:
                break
            states = self.closed(moved)
        return end

    def reach(self) -> int:
        return len(self.on)


def compile_template(label: str, markup: str) -> Automaton:
    on: list[dict[bytes, int]] = [{}]
    any_: list[int | None] = [None]
    skip: list[set[int]] = [set()]
    opened: list[int] = []
    runs: list[list[bytes]] = [[]]

    def add() -> int:
        on.append({})
        any_.append(None)
        skip.append(set())
        return len(on) - 1

    for m in _MARKUP.finditer(markup):
        if m[0] == "<<optional>>":
            opened.append(len(on) - 1)
            runs.append([])
        elif m[0] == "<<end>>":
            # a state of its own behind the region, so that regions in a row stay apart
            inside = len(on) - 1
            after = add()
            skip[inside].add(after)
            skip[opened.pop()].add(after)
            runs.append([])
        elif m[1]:
            enter = len(on) - 1
            gap = [enter]
            for _ in range(int(m[1])):
                t = add()
                any_[gap[-1]] = t
                gap.append(t)
            after = add()
            for s in gap:
                skip[s].add(after)
            runs.append([])
        else:
            for w in words_of(m[0]):
                s = len(on) - 1
                on[s][w] = add()
                if not opened:
                    runs[-1].append(w)
    if opened:
        raise ValueError(f"template {label}: a region is not closed")
    return Automaton(label, tuple(on), tuple(any_), tuple(map(frozenset, skip)), tuple(max(runs, key=len)))


def places(joined: bytes, phrase: bytes) -> list[int]:
    """Word positions where ``phrase`` stands in `` word word ... word ``."""
    needle, out, at = b" " + phrase + b" ", [], joined.find(b" " + phrase + b" ")
    words_before, seen = 0, 0
    while at >= 0:
        words_before += joined.count(b" ", seen, at)
        seen = at
        out.append(words_before)
        at = joined.find(needle, at + 1)
    return out


@dataclass(frozen=True)
class Scan:
    n_words: int
    base: list[tuple[int, str]]           # first word and label of each base place
    matches: list[tuple[int, int, str]]   # first word, end and label of each template match


class Scanner:
    def __init__(self, templates: dict[str, str] = TEMPLATES):
        self.automata = [compile_template(k, v) for k, v in templates.items()]

    def __call__(self, text: str) -> Scan:
        words = words_of(text)
        joined = b" " + b" ".join(words) + b" "
        base = [(at, label) for phrase, label in BASE_PHRASES for at in places(joined, phrase.encode())]
        matches = []
        for a in self.automata:
            # a match holds the anchor, and starts at most the automaton's length before it
            for anchor in places(joined, b" ".join(a.anchor)):
                for start in range(max(0, anchor - a.reach()), anchor + 1):
                    end = a.longest(words, start)
                    if end is not None and end > anchor:
                        matches.append((start, end, a.label))
                        break
        return Scan(len(words), base, matches)


def score_of(scan: Scan) -> float:
    """How surely the document carries a license: whole templates count more
    than bare phrases, and both more when found at several places."""
    doubt = 0.1 ** len({m[2] for m in scan.matches}) * 0.4 ** len({b[1] for b in scan.base})
    return 1.0 - doubt


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: counts and labels, and ``matches``, the accepted
    runs as label:first word:end."""
    docs = id_text(docs, id_col, text_col)
    fields = {"doc_id": dict(docs.dtypes)["doc_id"].replace("bigint", "long"), "n_words": "long", "n_base": "long",
              "first_word": "long", "last_word": "long", "base_labels": "string", "labels": "string",
              "score": "double", "matches": "string"}

    def make():
        scanner = Scanner(templates)

        def run(batch):
            out = {k: [] for k in fields}
            for doc, text in zip(column(batch, "doc_id").to_pylist(), texts(batch), strict=True):
                s = scanner(text)
                starts, own = [b[0] for b in s.base], {b[1] for b in s.base}
                row = (doc, s.n_words, len(starts), min(starts, default=None), max(starts, default=None),
                       ",".join(sorted(own)), ",".join(sorted(own | {m[2] for m in s.matches})), score_of(s),
                       ",".join(f"{k}:{a}:{b}" for a, b, k in s.matches))
                for k, cell in zip(fields, row, strict=True):
                    out[k].append(cell)
            return out
        return run

    return map_batches(docs, make, fields)


def template_regex(markup: str) -> str:
    """A regular expression for a template over words with a blank before each."""
    out = []
    for m in _MARKUP.finditer(markup):
        if m[0] == "<<optional>>":
            out.append("(?:")
        elif m[0] == "<<end>>":
            out.append(")?")
        else:
            out.append(f"(?: [^ ]+){{0,{m[1]}}}" if m[1] else f" {m[0]}")
    return "".join(out) + " "


def oracle_sql(templates: dict[str, str] = TEMPLATES) -> str:
    """DuckDB SQL for all columns but ``matches``, by list positions and regular
    expressions."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    places_ = " union all ".join(
        f"select r, place - 1 as place, '{label}' as label from spread where "
        + " and ".join(f"ws[place + {k}] = '{w}'" for k, w in enumerate(phrase.split()))
        for phrase, label in BASE_PHRASES)
    matched = " union all ".join(
        f"select r, '{label}' as label from words where regexp_matches(joined, '{template_regex(markup)}')"
        for label, markup in templates.items())
    return rf"""
with words as (select *, ' ' || array_to_string(ws, ' ') || ' ' as joined from (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{word}') as ws from documents)),
spread as (select r, ws, unnest(range(1, len(ws) + 1)) as place from words),
places as ({places_}), matched as ({matched}),
base as (select r, count(*) as n, min(place) as a, max(place) as z, list(distinct label) as own from places group by r),
more as (select r, list(distinct label) as own from matched group by r)
select doc_id, len(ws)::bigint as n_words, coalesce(n, 0)::bigint as n_base, a::bigint as first_word,
       z::bigint as last_word, coalesce(array_to_string(list_sort(base.own), ','), '') as base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.own, []), coalesce(more.own, [])))), ','), '')
         as labels,
       1 - power(0.1::double, coalesce(len(more.own), 0)) * power(0.4::double, coalesce(len(base.own), 0)) as score
from words left join base using (r) left join more using (r)"""
