"""Quality rules as a short-circuit cascade.

Each rule rejects a text or lets it pass.  On a sample every rule runs alone,
cold, and its cost and rejection rate are measured; the cascade then runs the
rules by rejections per unit of cost and stops at the first that rejects.  The
order changes the work, never the verdict: a text is kept if no rule rejects
it.

Defined cases: a null or empty text has no words and fails ``too_short``; a
null id passes through; repeated rows are judged one by one; an empty table
gives an empty result (the rules then keep their given order).  Texts are read
whole.  Columns other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, id_text, map_batches, texts

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
UPPER = bytes(range(65, 91))
NO_LETTERS = bytes(c for c in range(256) if c < 128 and not chr(c).isalpha())
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


class Facts:
    """What the rules ask of one text; each value is computed on first use."""

    def __init__(self, text: str):
        self.text = text

    @cached_property
    def bytes(self) -> bytes:
        return self.text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        # bytes.split() splits on exactly the six ASCII white-space characters
        return self.bytes.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        return repeat_words(self.words)

    @cached_property
    def n_stutter(self) -> int:
        """Words that repeat the word before them."""
        return sum(map(eq, self.words, self.words[1:]))

    @cached_property
    def n_upper(self) -> int:
        return len(self.bytes) - len(self.bytes.translate(None, UPPER))

    @cached_property
    def n_letters(self) -> int:
        """Bytes of ASCII letters and of characters beyond ASCII."""
        return len(self.bytes.translate(None, NO_LETTERS))


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of eight words found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    if len(seen) == len(words):
        return 0
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    key = mixed[:n].copy()
    for k in range(1, window):
        key = key * np.uint64(0xBF58476D1CE4E5B9) + mixed[k:k + n]
    ordered = np.sort(key)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0  # unequal keys: unequal windows
    rank, size = ids, 1
    while size < window:  # exact ranks of windows of 2, 4 and 8 words
        _, rank = np.unique(rank[:-size] * np.int64(rank.max() + 1) + rank[size:], return_inverse=True)
        size *= 2
    again = np.bincount(rank)[rank] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += again
    edge[window:] -= again
    return int((np.cumsum(edge[:-1]) > 0).sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Facts], bool]


BASE_RULES = (
    Rule("too_short", lambda f: f.n_words < MIN_WORDS),
    Rule("repeated_windows", lambda f: 100 * f.n_repeat_words > MAX_REPEAT_PERCENT * f.n_words),
)
RULES = BASE_RULES + (
    Rule("symbols", lambda f: 10 * f.n_symbols > 3 * f.n_words),
    Rule("repeated_lines", lambda f: 2 * f.n_dup_lines > len(f.lines)),
    Rule("stutter", lambda f: 2 * f.n_stutter > f.n_words),
    Rule("word_length", lambda f: not 2 * f.n_words <= f.word_chars <= 20 * f.n_words),
    Rule("shouting", lambda f: 2 * f.n_upper > f.n_letters),
    Rule("few_letters", lambda f: 2 * f.n_letters < f.word_chars),
)


def measure(docs: DataFrame, rules=RULES, sample_rows: int = 2000, seed: int = 42) -> dict[str, tuple[float, float]]:
    """(nanoseconds a text, share rejected) of each rule on about ``sample_rows``
    texts drawn from the whole table.  The driver receives one row per rule."""
    n = docs.count()
    sample = id_text(docs).sample(min(1.0, sample_rows / max(n, 1)), seed)

    def make():
        def run(batch):
            out = {"rule": [], "ns": [], "rejected": [], "n": []}
            tx = texts(batch)
            for rule in rules:
                began, hits = time.perf_counter_ns(), 0
                for t in tx:
                    hits += bool(rule.rejects(Facts(t)))
                for k, v in zip(out, (rule.name, time.perf_counter_ns() - began, hits, len(tx)), strict=True):
                    out[k].append(v)
            return out
        return run

    rows = (map_batches(sample, make, {"rule": "string", "ns": "long", "rejected": "long", "n": "long"})
            .groupBy("rule").agg(F.sum("ns").alias("ns"), F.sum("rejected").alias("rejected"), F.sum("n").alias("n"))
            .collect())
    return {r["rule"]: (r["ns"] / r["n"], r["rejected"] / r["n"]) for r in rows if r["n"]}


def cascade_order(rules, measured: dict[str, tuple[float, float]]):
    """Rules by rejections per nanosecond, the best first; unmeasured ones last."""
    def gain(rule):
        ns, share = measured.get(rule.name, (1.0, -1.0))
        return share / max(ns, 1.0)
    return sorted(rules, key=gain, reverse=True)


def quality_rules(docs: DataFrame, rules=RULES, sample_rows: int = 2000, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per text: its base counts, ``base_failed``, ``kept`` and
    ``rejected_by``, the first rule of the cascade that rejected it."""
    docs = id_text(docs, id_col, text_col)
    names = {r.name for r in BASE_RULES}
    ordered = cascade_order([r for r in rules if r.name not in names], measure(docs, rules, sample_rows))
    fields = {"doc_id": dict(docs.dtypes)["doc_id"].replace("bigint", "long"), "n_words": "long",
              "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
              "base_failed": "boolean", "kept": "boolean", "rejected_by": "string"}

    def make():
        def run(batch):
            out = {k: [] for k in fields}
            out["doc_id"] = column(batch, "doc_id")
            for t in texts(batch):
                f = Facts(t)
                by = next((r.name for r in (*BASE_RULES, *ordered) if r.rejects(f)), None)
                for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
                    out[k].append(getattr(f, k))
                out["base_failed"].append(by in names)
                out["kept"].append(by is None)
                out["rejected_by"].append(by)
            return out
        return run

    return map_batches(docs, make, fields)


def oracle_sql() -> str:
    """DuckDB SQL for the counts and the verdict of all rules."""
    word = r"[^\x20\x09-\x0D]+"
    return rf"""
with t as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '{word}') as ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{word}')) as ls from t),
windows as (select r, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') as s
            from (select r, ws, unnest(range(1, len(ws) - {WINDOW - 2})) as i from w)),
again as (select r, i from windows qualify count(*) over (partition by r, s) > 1),
covered as (select r, count(distinct i + k) as n from again, range({WINDOW}) as x(k) group by r),
f as (select doc_id, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
             (length(text) - length(translate(text, '{SYMBOLS}', '')))::bigint as n_symbols,
             (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words,
             len(ls) as n_lines, len(list_filter(range(1, len(ws)), lambda i: ws[i] = ws[i + 1])) as n_stutter,
             length(regexp_replace(text, '[^A-Z]', '', 'g')) as n_upper,
             length(regexp_replace(text, '[^A-Za-z]', '', 'g'))
               + strlen(regexp_replace(text, '[\x00-\x7F]', '', 'g')) as n_letters
      from w left join covered using (r)),
b as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed from f)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 10 * n_symbols > 3 * n_words or 2 * n_dup_lines > n_lines or 2 * n_stutter > n_words
            or word_chars < 2 * n_words or word_chars > 20 * n_words or 2 * n_upper > n_letters
            or 2 * n_letters < word_chars) as kept
from b"""
