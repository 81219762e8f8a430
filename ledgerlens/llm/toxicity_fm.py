"""Toxicity score from a factorization machine over hashed terms.

A text is the set of its terms: its words and their beginnings of four to
seven letters, hashed.  The machine adds a weight for each term and, for each pair of terms,
the product of their factor vectors, so that a pair such as an insult with a
group's name can weigh more than its parts.

Training reads a bounded sample of labelled rows (``per_class`` of each label).
Spark counts their terms; the driver learns in numpy from all that are in a few
texts, whatever their labels, as a term may count only together with another;
the hash space bounds their number.  Terms whose weights and factors move no
sampled text's score are dropped.  Scoring reads every text whole, a batch of
texts as one sparse table of rows and terms.

Defined cases: null and empty texts have no terms and get the machine's bias;
without labels of both kinds every score is that of the only label seen, or
0.5; a null id passes through and is not held out; repeated rows are scored one
by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from dataclasses import dataclass, replace
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, id_text, map_batches, materialize, rewrite_batches, texts
from .labelled import labelled_texts, sigmoid

HASH_BITS = 20
STEMS = (4, 5, 6, 7)
FACTORS = 4
MIN_DOCS = 4           # sampled texts a term must be in
FIRST_Z = 5.0          # terms whose shares differ by so many standard errors are learned first
PRUNE = 0.02           # how far dropped terms may move the sum before the logistic function of a sampled text
CACHE_WORDS = 200_000

# ASCII letters in lower case, other ASCII characters to blanks, the rest kept
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: str) -> set[bytes]:
    return set(text.encode("utf-8", "surrogatepass").translate(_FOLD).split())


def term_ids(word: bytes) -> tuple[int, ...]:
    """A word's own id and those of its beginnings."""
    letters = word.decode("utf-8", "replace")
    stems = [b"%d^" % n + letters[:n].encode() for n in STEMS if len(letters) >= n]
    return tuple(zlib.crc32(t) >> (32 - HASH_BITS) for t in (word, *stems))


def terms(text: str) -> list[int]:
    return sorted({t for w in words(text) for t in term_ids(w)})


@dataclass(frozen=True)
class FactorizationMachine:
    bias: float
    ids: np.ndarray       # sorted ids of the terms that have weights
    linear: np.ndarray    # one weight a term
    factors: np.ndarray   # one vector a term

    def raw(self, rows: list[np.ndarray]) -> np.ndarray:
        """Bias, linear and pairwise part; a row holds positions in ``ids``."""
        out = np.full(len(rows), self.bias)
        for i, r in enumerate(rows):
            if len(r):
                v = self.factors[r]
                out[i] += self.linear[r].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v * v).sum())
        return out


def frequent_terms(sample: DataFrame) -> np.ndarray:
    """Ids of the terms in at least MIN_DOCS of the rows ``label, terms``, at most
    the hash space's.  Labels do not matter: a difference of single terms says
    nothing of their pairs."""
    found = (sample.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("k"))
             .where(F.col("k") >= MIN_DOCS))
    return np.sort(found.select("term").toPandas()["term"].to_numpy(np.int64))


def positions(row: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Positions in ``ids`` (sorted) of those terms of a row that are there."""
    at = np.searchsorted(ids, row)
    return at[(at < len(ids)) & (ids[np.minimum(at, len(ids) - 1)] == row)].astype(np.int32) if len(ids) else (
        np.zeros(0, np.int32))


def telling(rows: list[np.ndarray], y: np.ndarray, n: int) -> np.ndarray:
    """Whether a term's shares among the texts of the two labels clearly differ."""
    at, of = np.concatenate(rows), np.repeat(y, [len(r) for r in rows])
    k, k1, n1, n0 = np.bincount(at, minlength=n), np.bincount(at, of, n), y.sum(), (1 - y).sum()
    share = k / len(y)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / n1 + 1 / n0))
    return np.abs(k1 / n1 - (k - k1) / n0) >= FIRST_Z * error


class Batch:
    """Rows with terms as runs: by row, and by term (``order`` sorts them so)."""

    def __init__(self, pick: np.ndarray, rows: list[np.ndarray]):
        self.pick, own = pick, [rows[i] for i in pick]
        lengths = np.array([len(r) for r in own])
        self.some = np.flatnonzero(lengths)
        self.starts = np.r_[0, np.cumsum(lengths[self.some])[:-1]]
        term = np.concatenate(own)
        order = np.argsort(term, kind="stable")
        self.used, self.at, local = np.unique(term[order], return_index=True, return_inverse=True)
        self.local = np.empty(len(term), np.int32)
        self.local[order] = local
        self.doc = np.repeat(np.arange(len(own), dtype=np.int32), lengths)[order]

    def of_rows(self, cells: np.ndarray) -> np.ndarray:
        """Sums of the used terms' cells in each row."""
        out = np.zeros((len(self.pick), cells.shape[1]))
        if len(self.some):
            out[self.some] = np.add.reduceat(cells[self.local], self.starts, axis=0)
        return out

    def of_terms(self, cells: np.ndarray) -> np.ndarray:
        """Sums of the rows' cells for each used term."""
        return np.add.reduceat(cells[self.doc], self.at, axis=0) if len(self.at) else np.zeros((0, cells.shape[1]))


def fit(samples: list[np.ndarray], y: np.ndarray, ids: np.ndarray, epochs: int = 60, batch: int = 64, rate: float = 0.2,
        ridge: float = 1e-4, seed: int = 42) -> FactorizationMachine:
    """Adagrad on the logistic loss with a ridge penalty, over the terms ``ids``
    (sorted); other terms of the samples do not count."""
    rng = np.random.default_rng(seed)
    if len(y) == 0 or y.min() == y.max():
        bias = 0.0 if len(y) == 0 else (4.0 if y[0] else -4.0)
        return FactorizationMachine(bias, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)))
    rows = [positions(s, ids) for s in samples]
    # factors so small that the pairs of an ordinary row add little at first
    spread = min(0.05, (0.05 / max(np.mean([len(r) for r in rows]), 1)) ** 0.5)
    w, v, b = np.zeros(len(ids)), rng.normal(0, spread, (len(ids), FACTORS)), 0.0
    sum_w, sum_v, sum_b = np.full(len(ids), 1e-6), np.full(v.shape, 1e-6), 1e-6
    # first the terms that tell by themselves; all terms then learn what is left
    first = telling(rows, y, len(ids))
    order = rng.permutation(len(rows))
    picks = [order[at:at + batch] for at in range(0, len(order), batch)]
    for rounds, known in ((epochs, [r[first[r]] for r in rows]), (epochs // 3, rows)):
        batches = [Batch(pick, known) for pick in picks]
        if known is rows:  # a row's terms move at once: the more, the less each
            least = 1e-6 * np.mean([len(r) for r in rows]) ** 2
            sum_w, sum_v = np.maximum(sum_w, least), np.maximum(sum_v, least)
        for k in (k for _ in range(rounds) for k in rng.permutation(len(batches))):
            own = batches[k]
            used, pick = own.used, own.pick
            vu = v[used]
            of_rows = own.of_rows(np.column_stack([vu, w[used] - 0.5 * (vu ** 2).sum(1)]))
            total = of_rows[:, :FACTORS]
            err = (sigmoid(b + of_rows[:, FACTORS] + 0.5 * (total ** 2).sum(1)) - y[pick]) / len(pick)
            sum_b += err.sum() ** 2
            b -= rate * err.sum() / np.sqrt(sum_b)
            grad = own.of_terms(np.column_stack([err[:, None] * total, err]))
            gw = grad[:, FACTORS] + ridge * w[used]
            gv = grad[:, :FACTORS] - grad[:, FACTORS:] * vu + ridge * vu
            sum_w[used] += gw ** 2
            sum_v[used] += gv ** 2
            w[used] -= rate * gw / np.sqrt(sum_w[used])
            v[used] -= rate * gv / np.sqrt(sum_v[used])
    return FactorizationMachine(b, ids, w, v)


def prune(model: FactorizationMachine, rows: list[np.ndarray], most: float = PRUNE) -> FactorizationMachine:
    """The machine without the terms of least weight, as many as leave the sum of
    every row within ``most`` of what it was.  ``rows`` hold positions."""
    if not len(model.ids) or not rows:
        return model
    before = model.raw(rows)
    pull = np.mean([np.linalg.norm(model.factors[r].sum(0)) for r in rows])
    order = np.argsort(np.abs(model.linear) + np.linalg.norm(model.factors, axis=1) * pull, kind="stable")

    def without(k: int) -> FactorizationMachine:
        gone = order[:k]
        linear, factors = model.linear.copy(), model.factors.copy()
        linear[gone], factors[gone] = 0, 0
        return replace(model, linear=linear, factors=factors)

    fits, fails = 0, len(order) + 1
    while fails - fits > max(1, len(order) // 256):
        k = (fits + fails) // 2
        if np.abs(without(k).raw(rows) - before).max() <= most:
            fits = k
        else:
            fails = k
    kept = np.sort(order[fits:])
    return FactorizationMachine(model.bias, model.ids[kept], model.linear[kept], model.factors[kept])


def train(docs: DataFrame, labels: DataFrame, label_col: str, usable: Column,
          per_class: int = 3000) -> FactorizationMachine:
    """The tasks turn sampled texts into term ids and count them; the driver
    receives the frequent terms, and of each text the positions of those of them
    that it has, four bytes each."""
    sample = labelled_texts(docs, labels, label_col, usable, per_class)
    fields = {"doc_id": "long", "label": "int", "terms": "array<long>"}

    def make():
        return lambda b: {"doc_id": column(b, "doc_id"), "label": column(b, "label"),
                          "terms": [terms(t) for t in texts(b)]}

    found = materialize(map_batches(sample, make, fields), "toxicity-terms")
    ids = frequent_terms(found)
    shared = docs.sparkSession.sparkContext.broadcast(ids)

    def keep():
        def run(b):
            rows = column(b, "terms").to_pylist()
            return {"doc_id": column(b, "doc_id"), "label": column(b, "label"),
                    "terms": [positions(np.array(r, np.int64), shared.value).tobytes() for r in rows]}
        return run

    rows = map_batches(found, keep, fields | {"terms": "binary"}).toPandas().sort_values("doc_id")
    own = [np.frombuffer(t, np.int32) for t in rows["terms"]]
    model = fit(own, rows["label"].to_numpy(float), np.arange(len(ids)))
    return prune(replace(model, ids=ids[:len(model.ids)]), own)


class Scorer:
    """Scores of texts; the terms of the words met so far are kept in a bounded
    table."""

    def __init__(self, model: FactorizationMachine):
        self.bias, self.n = model.bias, len(model.ids)
        self.at = np.full(1 << HASH_BITS, -1, np.int32)
        self.at[model.ids] = np.arange(self.n)
        # a row's sum needs the sum of its terms' factors, weights and squares
        self.cells = np.column_stack([model.factors, model.linear - 0.5 * (model.factors ** 2).sum(1)])
        self.clear()

    def clear(self) -> None:
        self.places: dict[bytes, int] = {}
        self.flat, self.starts, self.sizes = array("i"), array("q"), array("q")

    def learn(self, fresh: list[bytes]) -> None:
        if len(self.places) + len(fresh) > CACHE_WORDS:
            self.clear()
        for word in fresh:
            if word not in self.places:
                own = {p for t in term_ids(word) if (p := int(self.at[t])) >= 0}
                self.places[word] = len(self.sizes)
                self.starts.append(len(self.flat))
                self.sizes.append(len(own))
                self.flat.extend(own)

    def rows(self, tx: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Row and term of each different pair, by row."""
        own = [words(t) for t in tx]
        every = list(chain.from_iterable(own))
        if not all(map(self.places.__contains__, every)):
            self.learn([w for w in every if w not in self.places])
            if not all(map(self.places.__contains__, every)):  # the table started anew
                self.learn(every)
        at = np.fromiter(map(self.places.__getitem__, every), np.int64, len(every))
        row = np.repeat(np.arange(len(tx)), [len(w) for w in own])
        starts, sizes = (np.frombuffer(a, np.int64)[at] if len(at) else at for a in (self.starts, self.sizes))
        ends = np.cumsum(sizes)
        some = np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        term = np.frombuffer(self.flat, np.int32)[some] if len(some) else np.zeros(0, np.int32)
        return np.divmod(np.unique(np.repeat(row, sizes) * max(self.n, 1) + term), max(self.n, 1))

    def __call__(self, tx: list[str]) -> np.ndarray:
        row, term = self.rows(tx)
        sums = np.zeros((len(tx), self.cells.shape[1]))
        if len(row):
            first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            sums[row[first]] = np.add.reduceat(self.cells[term], first, axis=0)
        return sigmoid(self.bias + sums[:, -1] + 0.5 * (sums[:, :-1] ** 2).sum(1))


def score(docs: DataFrame, model: FactorizationMachine, threshold: float = 0.7, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` for every row."""
    docs = id_text(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = {"doc_id": dict(docs.dtypes)["doc_id"].replace("bigint", "long"), "score": "double", "predicted": "int"}

    def make():
        scorer = Scorer(shared.value)

        def run(batch):
            s = scorer(texts(batch))
            return {"doc_id": column(batch, "doc_id"), "score": s, "predicted": (s >= threshold).astype(np.int32)}
        return run

    return map_batches(docs, make, fields)


def drop_toxic(docs: DataFrame, model: FactorizationMachine, threshold: float = 0.7,
               text_col: str = "text") -> DataFrame:
    """The rows that score below ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(shared.value)
        return lambda b: b.filter(pa.array(scorer(texts(b, text_col)) < threshold))

    return rewrite_batches(docs, make)


def toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", usable: Column | None = None,
             threshold: float = 0.7) -> DataFrame:
    """Train on the usable labelled rows and score every document."""
    return score(docs, train(docs, labels, label_col, F.lit(True) if usable is None else usable), threshold)
