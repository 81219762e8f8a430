"""Silver, quarantine, audit and geo mart DDL, partitioned by day."""

from __future__ import annotations

from pyspark.sql import SparkSession

# --- fixed values: table layouts ---------------------------------------------
SILVER_DDL = """event_id string, transaction_id string, user_id string, card_id string, customer_id string,
  merchant_id string, merchant string, mcc string, amount double, currency string, payment_method string,
  channel string, country string, region string, city string, device_id string, device string, device_os string,
  device_ip string, velocity_1h double, distance_km_from_home double, metadata string, source string,
  schema_version string, risk_score double, is_international int, status string, approved string,
  decline_reason string, event_type string, event_ts timestamp, ingestion_ts timestamp,
  source_file string, dq_status string, dq_errors array<string>, amount_double double,
  approved_int int, is_international_int int, country_iso2 string, country_geo string,
  risk_bucket string, ds date, bronze_day date, ds_day date"""

QUARANTINE_DDL = """ingestion_ts timestamp, source_file string, raw_line string, dq_status string,
  dq_errors array<string>, dq_hard_errors array<string>, event_id string, transaction_id string,
  user_id string, event_ts string, bronze_day date, ds_day date"""

AUDIT_DDL = "dq_status string, records bigint, audit_ts timestamp, bronze_day date, ds_day date"

GEO_DDL = """country_name string, country_iso2 string, events_total bigint, transactions_total bigint,
  approved_total bigint, declined_total bigint, amount_sum double, risk_score_avg double,
  international_total bigint, ds date"""

# logical table -> columns, partition columns
TABLES = {
    "silver": (SILVER_DDL, "bronze_day, ds_day"),
    "quarantine": (QUARANTINE_DDL, "bronze_day, ds_day"),
    "audit": (AUDIT_DDL, "bronze_day, ds_day"),
    "geo": (GEO_DDL, "ds"),
}
# partitions where the table format allows hidden transforms: the geo mart is
# partitioned by the day of its date, the others by their day column as it is
TRANSFORMS = {"silver": "ds_day", "quarantine": "ds_day", "audit": "ds_day", "geo": "days(ds)"}


def create_table_sql(name: str, logical: str, location: str, table_format: str = "parquet") -> str:
    """DDL of one table.  ``table_format='iceberg'`` needs that runtime and a
    catalog on the cluster; parquet tables cannot take transforms."""
    ddl, columns = TABLES[logical]
    if table_format == "iceberg":
        return (f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING iceberg "
                f"PARTITIONED BY ({TRANSFORMS[logical]}) LOCATION '{location}' "
                "TBLPROPERTIES ('write.format.default'='parquet')")
    return (f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet "
            f"PARTITIONED BY ({columns}) LOCATION '{location}'")


def ensure_tables(spark: SparkSession, database: str, root: str, suffix: str = "",
                  table_format: str = "parquet") -> dict[str, str]:
    """Create the database and its tables if absent, all in one format.
    Returns logical name -> qualified table name."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = {logical: f"{database}.{logical}_events{suffix}" for logical in TABLES}
    for logical, name in names.items():
        spark.sql(create_table_sql(name, logical, f"{root.rstrip('/')}/{logical}", table_format))
    return names
