"""Small inputs with the awkward cases that every operator must survive."""

from __future__ import annotations

import numpy as np

SF_TINY, SF_SMALL, SF_MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int, words: int = 400) -> str:
    rng = np.random.default_rng(seed)
    syllables = ["an", "er", "the", "ti", "on", "re", "st", "ou", "ha", "ing"]
    pool = ["".join(rng.choice(syllables, rng.integers(1, 5))) for _ in range(words)]
    return " ".join(rng.choice(pool, n))


def awkward_rows() -> list[tuple]:
    """Null id, null, empty and blank texts, ties, repeated rows, long texts."""
    long = prose(1, 30000)
    some = prose(2, 300)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, some), (6, some), (7, some + " more"), (7, some + " more"),
            (8, long), (9, "x" * 5000), (10, "é ß 漢字 🙂 " * 30), (None, prose(3, 50)), (None, None), (11, "a\x0bb\x0cc\r\nd"),
            (12, long[:9000] + " other " + long[9000:20000]), (13, "A b\nA b\nA b\n" * 40)]
    return [(i, t, "en", None if i == 4 else f"s{(i or 0) % 3}", None if t is None else len(t)) for i, t in rows]


def documents(spark, rows=None):
    """A table of documents with a further column whose name clashes with those
    that operators add."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(awkward_rows() if rows is None else rows, DOC_SCHEMA)
    return df.withColumn("score", F.lit("mine")).withColumn("size", F.lit(-1)).withColumn("fp", F.lit("fp"))


def components(nodes, linked) -> dict:
    """Smallest reachable node of each node, by plain search."""
    out = {}
    for n in sorted(nodes):
        if n in out:
            continue
        todo = [n]
        while todo:
            u = todo.pop()
            if u not in out:
                out[u] = n
                todo += [v for v in linked(u) if v not in out]
    return out
