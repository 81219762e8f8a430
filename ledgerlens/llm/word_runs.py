"""Periodic runs of words, found from Lyndon arrays by Baier grouping.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical), at least ``max(MIN_WORDS, MIN_TURNS * q)`` words long, that no
neighbouring word extends with period q.

Lyndon arrays.  The first phase of Baier's suffix sorter puts suffixes into
groups by their longest Lyndon prefix: groups are worked from the highest down,
the members of a group are appended to the nearest lower suffix before them,
and those suffixes move to new groups just above their old ones, once for each
number of appended copies.  The length of the final prefix of each suffix is
the Lyndon array, under the order of the words and, with the order turned
round, under the other.  Nothing is sorted beyond the groups.

Runs.  Each run has Lyndon words of its period under one of the two orders
(its Lyndon roots), side by side, and at such a place the Lyndon array names
the period.  A run of four periods has three whole roots in a row, so places
where the array names the same period at two neighbouring roots are enough.
The longest common extensions to both sides, compared word by word in blocks of
doubling size, give the run.

Words outside.  A run needs every word of it to lie in a five-word window that
comes twice in the text (two windows a period apart lie in the run).  Grouping
is run on the maximal stretches of such words; windows are compared by 64-bit
hashes, and a false match makes a stretch longer without changing any run.

Defined cases: a null text has no words; a null id is never damaged and passes
through; repeated rows are worked one by one; an empty table gives an empty
result; long texts are split into words piece by piece, so that a text costs
the bytes of its words' numbers and of its distinct words; columns other than
id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
from pyspark.sql import DataFrame

from .common import column, id_text, map_batches

MIN_WORDS = 6
MIN_TURNS = 4
WINDOW = 5                 # words of the windows that a run repeats
PIECE_BYTES = 1 << 20
BLANKS = b" \t\n\x0b\x0c\r"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def lyndon_array(ranks: list[int]) -> list[int]:
    """For each place the length of the longest Lyndon word that starts there."""
    n = len(ranks)
    # groups by first word; ``below`` links them downwards, ``above`` upwards
    members: list[list[int]] = [[] for _ in range(max(ranks, default=-1) + 1)]
    for i, r in enumerate(ranks):
        members[r].append(i)
    group = list(ranks)
    length = [1] * len(members)
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members) + 1))
    # neighbours among the places whose groups are still to come
    left, right = list(range(-1, n)), list(range(1, n + 2))
    g = len(members) - 1
    while g >= 0:
        size, own, copies = length[g], members[g], {}
        for i in own:  # in ascending order, so that earlier members are out of the way
            if group[i] == g:
                p, q = left[i], right[i]
                right[p], left[q] = q, p  # right[-1] is a place beyond the text
                if p >= 0:
                    copies[p] = copies.get(p, 0) + 1
        if not copies:
            g = below[g]
            continue
        if len(copies) == 1:
            p, k = copies.popitem()
            parts = ((-k, group[p], (p,)),)
        else:
            moved: dict[tuple[int, int], list[int]] = {}
            for p, k in copies.items():
                key = -k, group[p]
                if key in moved:
                    moved[key].append(p)
                else:
                    moved[key] = [p]
            parts = [(*key, moved[key]) for key in sorted(moved)]
        for k, old, those in parts:
            fresh, up = len(length), above[old]
            for p in those:
                group[p] = fresh
            members.append(those)
            length.append(length[old] - k * size)
            below.append(old)
            above.append(up)
            above[old] = below[up] = fresh
        g = below[g]
    return [length[x] for x in group]


def extension(words: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words from ``a`` and ``b`` (``a < b``) on are equal, to the
    right (``step`` 1) or to the left (-1)."""
    room = len(words) - b if step > 0 else a + 1
    found, block = 0, 8
    while found < room:
        k = min(block, room - found)
        if step > 0:
            x, y = words[a + found:a + found + k], words[b + found:b + found + k]
        else:
            x, y = words[a - found - k + 1:a - found + 1][::-1], words[b - found - k + 1:b - found + 1][::-1]
        differ = x != y
        if differ.any():
            return found + int(differ.argmax())
        found, block = found + k, block * 2
    return found


def runs_of(words: np.ndarray) -> set[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of a stretch of word numbers."""
    found: set[tuple[int, int, int]] = set()
    distinct, ranks = np.unique(words, return_inverse=True)
    for order in (ranks, len(distinct) - 1 - ranks):
        period = np.asarray(lyndon_array(order.tolist()), np.int64)
        n, at = len(period), np.arange(len(period))
        root = (MIN_TURNS * period <= n) & (period[np.minimum(at + period, n - 1)] == period) & (at + period < n)
        reach: dict[int, int] = {}  # by period, the end of the places whose extension is known
        for i, q in zip(np.flatnonzero(root).tolist(), period[root].tolist(), strict=True):
            if i < reach.get(q, 0):
                continue
            right = extension(words, i, i + q, 1)
            reach[q] = i + right
            if right < q:
                continue
            left = extension(words, i - 1, i + q - 1, -1)
            size = left + q + right
            if size >= max(MIN_WORDS, MIN_TURNS * q):
                found.add((i - left, size, q))
    return found


def _repeated(words: np.ndarray) -> np.ndarray:
    """Whether each word lies in a window that comes twice."""
    covered = np.zeros(len(words), bool)
    if len(words) < MIN_WORDS:
        return covered
    mixed = (words.astype(np.uint64) + np.uint64(1)) * _MIX
    mixed ^= mixed >> np.uint64(29)
    hashes = np.zeros(len(words) - WINDOW + 1, np.uint64)
    for k in range(WINDOW):
        hashes = hashes * np.uint64(0xD1342543DE82EF95) + mixed[k:k + len(hashes)]
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    twice = np.zeros(len(hashes), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    for k in range(WINDOW):
        covered[k:k + len(twice)] |= twice
    return covered


def find_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run, by start, then period."""
    covered = _repeated(words)
    edges = np.flatnonzero(np.diff(np.r_[False, covered, False]))
    found = []
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        if b - a >= MIN_WORDS:
            found += [(a + s, size, q) for s, size, q in runs_of(words[a:b])]
    return sorted(found, key=lambda r: (r[0], r[2]))


def pieces(data: bytes, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, as lists from pieces of about ``size`` bytes."""
    at = 0
    while at < len(data):
        end = at + size
        while end < len(data) and data[end] not in BLANKS:
            end += 1
        yield data[at:end].split()  # splits at the ASCII blanks
        at = end


def word_numbers(data: bytes) -> tuple[np.ndarray, list[bytes]]:
    """The text's words as numbers, and the distinct words."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    parts = [np.zeros(0, np.int32)]
    for words in pieces(data):
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
    return np.concatenate(parts), list(numbers)


def damaged(words: np.ndarray, doc_id) -> np.ndarray:
    """The contract's periodic tail in every tenth document, by its id."""
    if doc_id is None or not len(words):
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return np.r_[words[:a], words[a + np.arange(n - a) % period]]


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """False for words that a run holds after its first period."""
    depth = np.zeros(n + 1, np.int64)
    for start, size, q in runs:
        depth[start + q] += 1
        depth[start + size] -= 1
    return np.cumsum(depth[:n]) == 0


def word_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: bool = False,
              collapse: bool = True) -> DataFrame:
    """One row per document: its runs as arrays ``starts``, ``lengths`` and
    ``periods`` (by start, then period), ``best`` (index of the run with the
    greatest length by period, or null) and ``collapsed``, the words that no run
    repeats, joined by single blanks (null unless ``collapse``).  ``damage``
    plants the contract's periodic tails first."""
    docs = id_text(docs, id_col, text_col)
    fields = {"doc_id": dict(docs.dtypes)["doc_id"].replace("bigint", "long"), "starts": "array<long>",
              "lengths": "array<long>", "periods": "array<long>", "best": "int", "collapsed": "string"}

    def make():
        def run(batch):
            out = {k: [] for k in fields}
            for doc, text in zip(column(batch, "doc_id").to_pylist(), column(batch, "text"), strict=True):
                words, distinct = word_numbers((text.as_py() or "").encode())
                words = damaged(words, doc) if damage else words
                runs = find_runs(words)
                best = None
                for k, (_, size, q) in enumerate(runs):
                    if best is None or size * runs[best][2] > runs[best][1] * q:
                        best = k
                kept = words[kept_words(len(words), runs)] if runs else words
                joined = b" ".join(map(distinct.__getitem__, kept.tolist())).decode() if collapse else None
                row = (doc, [r[0] for r in runs], [r[1] for r in runs], [r[2] for r in runs], best, joined)
                for k, cell in zip(fields, row, strict=True):
                    out[k].append(cell)
            return out
        return run

    return map_batches(docs, make, fields)
