"""Rerun-safe writers.

What a write replaces is said with each write, never by a session setting:
``replace_folder`` clears a whole folder first (a batch's own output, also when
the new output is empty or lies in other days); ``write_partitioned`` replaces
the partitions its rows touch, and ``clear_partitions`` those that a rerun left
without rows.

``rebalance=True`` adds a ``rebalance`` hint on the partition columns: AQE
then gathers each partition value into few files, splitting a hot value over
several tasks and merging tiny outputs.  It is used for the marts and the
quarantine.  A mart grouped by (day, key) comes out of a shuffle hashed on
both, so without it every reducer would write a small file into every day it
holds (reducers x days files per mart); the extra shuffle moves only the
aggregated rows.  The quarantine is sparse and written from thousands of map
tasks.  Silver is written without it, from its input splits: files are sized
by the input, and a second full shuffle of silver would only cost network.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

# concurrent write jobs submitted by one driver (small final stages of many
# marts overlap instead of leaving executors idle between them)
DEFAULT_PARALLEL_WRITES = 4


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str],
                      mode: str = "overwrite", compression: str = "snappy", rebalance: bool = False) -> None:
    if rebalance:
        df = df.hint("rebalance", *partition_cols)
    (df.write.mode(mode)
       .option("partitionOverwriteMode", "dynamic")
       .option("compression", compression)
       .partitionBy(*partition_cols)
       .parquet(path))


def replace_folder(df: DataFrame, path: str, partition_cols: list[str], compression: str = "snappy",
                   rebalance: bool = False) -> None:
    """Make ``path`` hold exactly ``df``, whatever it held before."""
    if rebalance:
        df = df.hint("rebalance", *partition_cols)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", compression)
       .partitionBy(*partition_cols).parquet(path))


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files under a folder."""
    fs, p = _hadoop_path(spark, path)
    return fs.getContentSummary(p).getLength()


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return fs.exists(p)


def clear_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, if there."""
    fs, p = _hadoop_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Make a folder the content of ``target``, whatever that held before."""
    clear_folder(spark, target)
    fs, p = _hadoop_path(spark, target)
    fs.mkdirs(p.getParent())
    if not fs.rename(_hadoop_path(spark, source)[1], p):
        raise OSError(f"{source} cannot be moved to {target}")


def clear_partitions(spark: SparkSession, path: str, partition_col: str, values) -> None:
    """Delete the partitions of these values (one folder each), if there."""
    for v in values:
        clear_folder(spark, f"{path.rstrip('/')}/{partition_col}={v}")


def _in_table_order(df: DataFrame, spark: SparkSession, table: str) -> DataFrame:
    # insertInto is positional: align by name first
    return df.select(*spark.table(table).columns)


def append_table(df: DataFrame, table: str, table_format: str = "parquet") -> None:
    """Append rows to a catalog table (``writeTo(..).append()`` for Iceberg;
    v1 parquet tables take ``insertInto``)."""
    if table_format == "iceberg":
        df.writeTo(table).append()
        return
    _in_table_order(df, df.sparkSession, table).write.insertInto(table)


def overwrite_table_partitions(df: DataFrame, table: str, table_format: str = "parquet") -> None:
    """Replace only the partitions present in ``df`` (idempotent rerun)."""
    if table_format == "iceberg":
        df.writeTo(table).overwritePartitions()
        return
    spark = df.sparkSession
    # a session of its own carries the setting; the catalog is shared
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    view = f"overwrite_{uuid.uuid4().hex}"
    _in_table_order(df, spark, table).createGlobalTempView(view)
    try:
        own.table(f"global_temp.{view}").write.insertInto(table, overwrite=True)
    finally:
        spark.catalog.dropGlobalTempView(view)


def snapshot_table(df: DataFrame, table: str, location: str, compression: str = "gzip") -> None:
    """CREATE TABLE AS SELECT: materialise a view's current result."""
    df.write.mode("overwrite").option("compression", compression).option("path", location).saveAsTable(table)


def replace_table_property(spark: SparkSession, table: str, unset: list[str], set_props: dict) -> None:
    """Drop deprecated properties (no error if absent) and set replacements."""
    if unset:
        keys = ", ".join(f"'{k}'" for k in unset)
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({keys})")
    if set_props:
        kv = ", ".join(f"'{k}'='{v}'" for k, v in set_props.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({kv})")


def run_concurrently(actions, max_parallel: int = DEFAULT_PARALLEL_WRITES) -> list:
    """Run independent Spark actions (zero-argument callables) as concurrent
    jobs of the same session; re-raises the first failure."""
    actions = list(actions)
    if max_parallel <= 1 or len(actions) <= 1:
        return [a() for a in actions]
    with ThreadPoolExecutor(max_workers=min(max_parallel, len(actions))) as pool:
        futures = [pool.submit(a) for a in actions]
        return [f.result() for f in futures]
