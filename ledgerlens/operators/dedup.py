"""Keep-latest deduplication by key.

Expressed as ``groupBy(key).agg(max(struct(order..., rest...)))`` instead of
a ``row_number`` window: ``max`` is algebraic, so each map task collapses its
copies of a key before the shuffle.  A key holding a third of all rows then
costs one row per task, not one giant sorted partition.  Rows with a NULL key
are not duplicates of each other: each gets its own group through a second
grouping column (a row id that is set only when the key is NULL), so the
input is read once and NULL-key rows spread over all reducers.  The row id
(``monotonically_increasing_id``) carries the partition index in its upper
bits; a retried task renumbers only rows of its own partition, so every row
still lands in exactly one group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return not isinstance(dt, (T.VariantType,))


def dedup_latest(df: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """One row per non-NULL ``key``: the greatest by ``order_by`` (latest
    first), ties broken by the remaining columns so the pick is
    deterministic.  Output has the input's columns in the input's order."""
    rest = [c for c in df.columns if c != key and c not in order_by]
    if not all(_orderable(df.schema[c].dataType) for c in order_by + rest):
        raise TypeError("dedup_latest needs orderable columns (no maps)")
    packed = F.struct(*[F.col(c) for c in order_by + rest])
    null_row = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    return (df.withColumn("_null_row", null_row)
              .groupBy(key, "_null_row").agg(F.max(packed).alias("_row"))
              .select(key, "_row.*")
              .select(*df.columns))
