"""Landing ledger: which bronze files the committed silver was made from.

The ledger lists every landed file with its length and time; it is written with
a run and named by that run's commit, so it never says more than silver holds.
Comparing it with the files that lie there now gives the bronze days to run:
those with a new, a changed or a vanished file.  Only file metadata is read for
that, no line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.writers import folder_exists

LEDGER_DDL = "path string, length bigint, modified timestamp, bronze_day date"


def landed_files(spark: SparkSession, bronze_root: str) -> DataFrame:
    """The files that lie under a bronze root, with their folder day; the
    content column is not read."""
    if not folder_exists(spark, bronze_root):
        return spark.createDataFrame([], LEDGER_DDL)
    day = F.make_date(*[F.col(c).cast("int") for c in ("year", "month", "day")])
    return spark.read.format("binaryFile").load(bronze_root).select(
        "path", "length", F.col("modificationTime").alias("modified"), day.alias("bronze_day"))


def write_ledger(files: DataFrame, root: str, run: str) -> DataFrame:
    path = f"{root}/ledger/run={run}"
    files.write.mode("overwrite").parquet(path)
    return files.sparkSession.read.schema(LEDGER_DDL).parquet(path)


def read_ledger(spark: SparkSession, root: str, run: str) -> DataFrame:
    """The ledger of a run; empty for a lake that has none."""
    return spark.read.schema(LEDGER_DDL).parquet(f"{root}/ledger/run={run}") if run else spark.createDataFrame([], LEDGER_DDL)


def open_days(known: DataFrame, now: DataFrame) -> list[str]:
    """Bronze days whose files differ (one row a day comes back)."""
    def tagged(df: DataFrame, n: int) -> DataFrame:
        return df.select("path", "length", "modified", "bronze_day", F.lit(n).alias("n"))

    # a file that is the same on both sides sums to zero
    differing = (tagged(known, -1).unionByName(tagged(now, 1)).groupBy("path", "length", "modified", "bronze_day")
                 .agg(F.sum("n").alias("n")).where("n <> 0"))
    return sorted(str(r["bronze_day"]) for r in differing.select("bronze_day").distinct().collect())
