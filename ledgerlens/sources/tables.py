"""Parquet tables: scans, external-table DDL, partition discovery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """``df`` dealt round-robin over ``partitions``, or as it is if not given.

    A parquet row group or a gzip file is read by one task, so a few large
    ones leave cores idle through every per-row expression; whoever knows the
    input names the count."""
    return df.repartition(partitions) if partitions else df


def scan_day(spark: SparkSession, root: str, day: str, partition_col: str = "ds_day") -> DataFrame:
    """Rows of one partition day.  The filter is on the partition column, so
    only that folder is listed and read (PartitionFilters in the plan) and the
    partition column stays in the output (a leaf-path read would lose it)."""
    return spark.read.parquet(root).where(F.col(partition_col) == F.lit(day).cast("date"))


def scan_paths(spark: SparkSession, paths: list[str], base_path: str | None = None) -> DataFrame:
    """Union of several partition folders in one scan (one file listing,
    one stage), keeping partition columns when ``base_path`` is given."""
    reader = spark.read
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.parquet(*paths)


def create_external_table(spark: SparkSession, name: str, schema_ddl: str, location: str,
                          partitioned_by: list[str] | None = None, fmt: str = "parquet",
                          properties: dict | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS .. USING parquet [PARTITIONED BY] LOCATION``."""
    parts = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    props = ""
    if properties:
        props = " TBLPROPERTIES (" + ", ".join(f"'{k}'='{v}'" for k, v in properties.items()) + ")"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema_ddl}) USING {fmt}{parts} LOCATION '{location}'{props}")


def repair_partitions(spark: SparkSession, name: str) -> None:
    """Register partition folders written outside the catalog."""
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def latest_partition_day(spark: SparkSession, table: str, partition_col: str = "ds_day") -> DataFrame:
    """Latest partition day from catalog metadata (no data files are read).
    One row ``latest_day``; NULL when the table has no partition."""
    parts = spark.sql(f"SHOW PARTITIONS {table}")
    pat = rf"(^|/){partition_col}=([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})"
    day = F.to_date(F.regexp_extract(F.col("partition"), pat, 2))
    return parts.agg(F.max(day).alias("latest_day"))


def require_latest_day(spark: SparkSession, table: str, partition_col: str = "ds_day"):
    """The latest day as a ``datetime.date``; error if the table is empty."""
    day = latest_partition_day(spark, table, partition_col).first()["latest_day"]
    if day is None:
        raise ValueError(f"no partition found in {table}")
    return day
