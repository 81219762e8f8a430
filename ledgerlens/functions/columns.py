"""Schema-tolerant column access (silver layouts differ between writers)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_present(df: DataFrame, names: list[str], dtype: str) -> Column:
    """First value of type ``dtype`` over the alternative columns that exist.

    Values that do not convert count as NULL (ANSI mode is on, so a plain cast
    would fail the job); with no such column the result is a typed NULL.
    """
    typed = [F.col(f"`{n}`").try_cast(dtype) for n in names if n in df.columns]
    return F.coalesce(*typed, F.lit(None).cast(dtype))


def safe_col(df: DataFrame, name: str, dtype: str) -> Column:
    """``first_present`` of a single column."""
    return first_present(df, [name], dtype)


def with_columns_once(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """``df.withColumns(exprs)``, but each expression is evaluated exactly
    once per row, whatever filters come later.

    A filter on a derived column is pushed below the projection that derives
    it, and the optimizer then substitutes the expression for every
    reference: a filter on a grade computed from ``from_json`` fields ran the
    JSON parser once per field it touched.  Producing the columns from a
    one-row generator (``inline(array(struct(..)))``) stops that: a predicate
    on a generator's output stays above the generator.  The values are
    computed in a projection first (which shares common subexpressions; a
    generator does not) and only passed through.  The cost is one small
    array per row."""
    rest = [c for c in df.columns if c not in exprs]
    computed = df.select(*rest, *[e.alias(n) for n, e in exprs.items()])
    return computed.select(*rest, F.inline(F.array(F.struct(*[F.col(n) for n in exprs]))))
