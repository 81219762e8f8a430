"""Splitting large groups into pairs of blocks, and walking sorted groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column


def in_blocks(rows: DataFrame, key: str, spread: Column, block: int) -> DataFrame:
    """Replace ``key`` (a long) by that of a group to compare within, and add
    ``side``.  A key with at most ``block`` rows stays one group with side -1.
    A larger one is dealt by ``spread`` into blocks, and each pair of blocks is
    a group: within one block sides are -1, across two they name the block, and
    only rows of different sides need comparing."""
    large = rows.groupBy(key).count().where(F.col("count") > block)
    blocks = F.coalesce(F.ceil(F.col("count") / block), F.lit(1)).cast("int")
    return (rows.join(large, key, "left").withColumn("blocks", blocks)
            .withColumn("own", F.pmod(spread, F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
            .withColumn("side", F.when(F.col("own") != F.col("other"), F.col("own")).otherwise(-1))
            .withColumn(key, F.when(F.col("blocks") == 1, F.col(key)).otherwise(
                F.xxhash64(key, F.least("own", "other"), F.greatest("own", "other"))))
            .drop("count", "blocks", "own", "other"))


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, chunk: int) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``key``, each of about
    ``chunk`` rows, or of one group if that is larger."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        keys = column(batch, key).to_numpy()
        last = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        fresh = not held or (len(keys) > 0 and column(held[-1], key)[-1].as_py() != keys[0])
        if size >= chunk and held and fresh:
            yield pa.Table.from_batches(held)
            held, size = [], 0
        if size + last >= chunk and last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held, size, batch = [], 0, batch.slice(last)
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)
