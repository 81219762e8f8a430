"""Helpers shared by the training-data operators.

Text work runs in Arrow batches inside Spark tasks (``map_batches``); what a
task keeps in memory is one slice of a batch.  Intermediate tables go to the
shared folder of ``spark.checkpoint.dir`` (``materialize``), so a lost
executor costs the tasks it held and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

ARROW_ROWS = 1000     # rows of a batch that Spark hands to a Python worker
SLICE_ROWS = 256      # rows of a batch that are Python objects at one time

ARROW_TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
               "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
               "array<int>": pa.list_(pa.int32()),
               "array<double>": pa.list_(pa.float64())}


def bound_batches(spark: SparkSession) -> None:
    """Long texts make batches of Spark's default 10,000 rows too large for a
    Python worker, so the session's batch is lowered."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_schema(fields: dict[str, str]) -> pa.Schema:
    return pa.schema([(n, ARROW_TYPES[t]) for n, t in fields.items()])


def ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in fields.items())


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], fields: dict[str, str],
                rows: int = SLICE_ROWS) -> DataFrame:
    """Map slices of at most ``rows`` rows.  ``make`` runs once in each task and
    returns the function from a slice to a dict of output columns."""
    schema = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield pa.RecordBatch.from_pydict(fn(batch.slice(at, rows)), schema=schema)

    return df.mapInArrow(run, ddl(fields))


def rewrite_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
                    rows: int = SLICE_ROWS) -> DataFrame:
    """Map slices to batches with the columns of ``df``, whatever they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield fn(batch.slice(at, rows))

    return df.mapInArrow(run, df.schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; a null text counts as empty."""
    return ["" if t is None else t for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, whatever else the table carries."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def id_crc32(col: str | Column = "doc_id") -> Column:
    """crc32 of an id's decimal text."""
    return F.crc32((F.col(col) if isinstance(col, str) else col).cast("string").cast("binary"))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
