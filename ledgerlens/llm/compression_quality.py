"""Quality score from two zstandard dictionaries.

One dictionary is built from text labelled good, one from text labelled bad.
A text that compresses better with the good one is more like good text: the
difference of the two compressed sizes over the text's size, calibrated by a
logistic curve (which also knows how short the text is) on labelled texts that
are in neither dictionary, is the score.

Training reads a bounded sample of labelled rows (``per_class`` of each label,
texts of at most ``max_train_chars``); scoring reads every text whole.

Defined cases: null and empty texts have difference 0 and the shortest length
and get the score calibrated for those; without labels of both kinds every score is that of the only label seen,
or 0.5; a null id passes through and is not held out; repeated rows are scored
one by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, id_text, map_batches, texts
from .labelled import fit_logistic, label_counts, labelled_texts, sigmoid

DICTIONARY_BYTES = 65536
LEVEL = 3
SHORT_BYTES = 300
PART_BYTES = 2048     # a text is compressed in parts, else a long one's own beginning replaces the dictionary


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]   # of the features, then the intercept


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False)


def features(tx: list[str], good: bytes, bad: bytes) -> np.ndarray:
    """Per text the normalised difference, also damped, and how short the text
    is, alone and with the difference: that of a short text is mostly noise."""
    by_good, by_bad = _compressor(good), _compressor(bad)
    out = np.zeros((len(tx), 4))
    for i, t in enumerate(tx):
        raw = t.encode("utf-8", "surrogatepass")
        gap = 0
        for at in range(0, len(raw), PART_BYTES):
            part = raw[at:at + PART_BYTES]
            gap += len(by_bad.compress(part)) - len(by_good.compress(part))
        difference, short = 100 * gap / max(len(raw), 1), np.exp(-len(raw) / SHORT_BYTES)
        out[i] = difference, 100 * gap / (len(raw) + 500), short, short * difference
    return out


def _dictionary(tx: list[str]) -> bytes:
    raw = [t.encode("utf-8", "surrogatepass") for t in tx if t]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, raw).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their text itself is the dictionary
        return b"".join(raw)[-DICTIONARY_BYTES:]


def train(docs: DataFrame, labels: DataFrame, label_col: str, usable: Column, per_class: int = 2000,
          max_train_chars: int = 20000) -> CompressionModel:
    """Even positions of the sample build the dictionaries, odd ones calibrate."""
    rows = labelled_texts(docs, labels, label_col, usable, per_class, max_train_chars).toPandas()
    rows = rows.sort_values("doc_id")
    build, check = [], []
    for label in (0, 1):
        tx = rows["text"][rows["label"] == label].tolist()
        build.append(tx[::2])
        check += [(t, label) for t in tx[1::2]]
    bad, good = map(_dictionary, build)
    y = np.array([label for _, label in check], int)
    counts, drawn = label_counts(labels, label_col, usable), np.maximum(np.bincount(y, minlength=2), 1)
    # each class weighs as in all labelled rows, however many of it were drawn
    weight = np.array([counts[k] / drawn[k] for k in (0, 1)])[y] if len(y) else np.ones(0)
    return CompressionModel(good, bad, tuple(fit_logistic(features([t for t, _ in check], good, bad), y, weight)))


def score(docs: DataFrame, model: CompressionModel, threshold: float = 0.7, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` for every row."""
    docs = id_text(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = {"doc_id": dict(docs.dtypes)["doc_id"].replace("bigint", "long"), "score": "double", "predicted": "int"}

    def make():
        m = shared.value
        w = np.array(m.weights)

        def run(batch):
            s = sigmoid(features(texts(batch), m.good, m.bad) @ w[:-1] + w[-1])
            return {"doc_id": column(batch, "doc_id"), "score": s, "predicted": (s >= threshold).astype(np.int32)}
        return run

    return map_batches(docs, make, fields)


def compression_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality",
                        usable: Column | None = None, threshold: float = 0.7) -> DataFrame:
    """Train on the usable labelled rows and score every document."""
    return score(docs, train(docs, labels, label_col, F.lit(True) if usable is None else usable), threshold)
