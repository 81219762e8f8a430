"""Reporting views over the gold marts, as DataFrame functions.

``as_of`` replaces ``current_date`` so results are reproducible.
``create_view_functions`` stores them in the catalog, for queries by name:
``SELECT * FROM v_geo_daily_90d(DATE'2024-01-31')``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import country_surrogate
from ..sources.dimensions import dim_country_latlon


def _since(as_of, days: int):
    return F.date_sub(F.lit(str(as_of)).cast("date"), days)


def v_fraud_kpis_daily(daily: DataFrame) -> DataFrame:
    """Wide daily mart plus percentages (NULL when there are no rows)."""
    tx = F.nullif(F.col("transactions_total"), F.lit(0))
    return daily.select("*",
                        (F.lit(100.0) * F.col("declined_total") / tx).alias("decline_rate_pct"),
                        (F.lit(100.0) * F.col("international_total") / tx).alias("international_rate_pct"))


def v_gold_fraud_dashboard(daily: DataFrame) -> DataFrame:
    """Approval and decline ratios (NULL instead of an error on 0 rows)."""
    tx = F.col("transactions_total").cast("double")
    return daily.select("ds_day", "events_total", "transactions_total", "approved_total", "declined_total",
                        "amount_sum", "amount_avg", "risk_score_avg", "international_total",
                        F.try_divide(F.col("approved_total").cast("double"), tx).alias("approval_rate"),
                        F.try_divide(F.col("declined_total").cast("double"), tx).alias("decline_rate"))


def v_geo_daily(geo: DataFrame, as_of: dt.date, days: int = K.GEO_LOOKBACK_DAYS) -> DataFrame:
    """Trailing-window roll-up per (ds, country): sums of sums and the
    unweighted mean of the daily means (as the original view)."""
    return (geo.where((F.col("ds") >= _since(as_of, days)) & F.col("country_iso2").isNotNull())
               .groupBy("ds", "country_iso2")
               .agg(F.sum("events_total").alias("events_total"),
                    F.sum("amount_sum").alias("amount_sum"),
                    F.avg("risk_score_avg").alias("risk_score_avg"),
                    F.sum("international_total").alias("international_total")))


def v_geo_daily_weighted(geo: DataFrame, as_of: dt.date, days: int = K.GEO_LOOKBACK_DAYS) -> DataFrame:
    """Same roll-up with the risk mean weighted by each row's event count."""
    w = F.col("risk_score_avg") * F.col("events_total")
    return (geo.where((F.col("ds") >= _since(as_of, days)) & F.col("country_iso2").isNotNull())
               .groupBy("ds", "country_iso2")
               .agg(F.sum("events_total").alias("events_total"),
                    F.sum("amount_sum").alias("amount_sum"),
                    F.try_divide(F.sum(w), F.sum(F.when(F.col("risk_score_avg").isNotNull(), F.col("events_total"))))
                     .alias("risk_score_avg"),
                    F.sum("international_total").alias("international_total")))


def v_geo_dashboard_latlon(spark: SparkSession, geo: DataFrame, as_of: dt.date,
                           days: int = K.GEO_LOOKBACK_DAYS) -> DataFrame:
    """Geo mart with coordinates for the trailing window.  The dimension is a
    fixed 4-row literal, so broadcasting it is safe.  ``<> 'UNK'`` also drops
    NULL codes (three-valued logic), as the original view does."""
    g = geo.where((F.col("ds") >= _since(as_of, days)) & (F.col("country_iso2") != F.lit(K.UNKNOWN_ISO2)))
    d = F.broadcast(dim_country_latlon(spark))
    return (g.join(d, g["country_iso2"] == d["country_iso2"], "left")
             .select(g["ds"], g["country_iso2"], g["country_name"], g["events_total"], g["transactions_total"],
                     g["approved_total"], g["declined_total"], g["amount_sum"], g["risk_score_avg"],
                     g["international_total"], d["lat"], d["lon"]))


def silver_fraud_events_geo_v(silver: DataFrame) -> DataFrame:
    """Silver with a stable pseudo-country per event (no geo lookup)."""
    return silver.select("ds", country_surrogate(F.col("event_id"), F.col("is_international_int")).alias("country_iso2"),
                         "amount_double", "risk_score", "approved_int", "is_international_int")


def latest_rows(df: DataFrame, order_cols: list, n: int = 10) -> DataFrame:
    """Newest ``n`` rows by a total order (TakeOrderedAndProject: each task
    keeps its own top ``n``; only n x tasks rows reach the final merge)."""
    return df.orderBy(*order_cols).limit(n)


def passthrough(spark: SparkSession, table: str) -> DataFrame:
    """``SELECT * FROM table`` pass-through view."""
    return spark.table(table)


def create_view_functions(spark: SparkSession, geo_table: str, daily_table: str, database: str = "default",
                          days: int = K.GEO_LOOKBACK_DAYS) -> None:
    """Store the reporting views over a geo and a daily mart table in the
    catalog: the two with a date as table functions of that date, the two
    without as views.  A table function is called by its bare name, so the
    caller's current database must be ``database``."""
    since = f"ds >= date_sub(as_of, {int(days)})"
    geo = {f.name: f.dataType.simpleString() for f in spark.table(geo_table).schema.fields}
    point = ", ".join(f"('{c}', CAST({lat!r} AS DOUBLE), CAST({lon!r} AS DOUBLE))" for c, lat, lon in K.COUNTRY_LATLON)
    spark.sql(f"""CREATE OR REPLACE FUNCTION {database}.v_geo_daily_90d(as_of DATE COMMENT 'last day')
        RETURNS TABLE(ds DATE, country_iso2 STRING, events_total BIGINT, amount_sum DOUBLE, risk_score_avg DOUBLE,
                      international_total BIGINT)
        RETURN SELECT ds, country_iso2, sum(events_total), sum(amount_sum), avg(risk_score_avg),
                      sum(international_total)
               FROM {geo_table} WHERE {since} AND country_iso2 IS NOT NULL GROUP BY ds, country_iso2""")
    columns = ["ds", "country_iso2", "country_name", "events_total", "transactions_total", "approved_total",
               "declined_total", "amount_sum", "risk_score_avg", "international_total"]
    spark.sql(f"""CREATE OR REPLACE FUNCTION {database}.v_geo_dashboard_latlon_90d(as_of DATE COMMENT 'last day')
        RETURNS TABLE({", ".join(f"{c} {geo[c]}" for c in columns)}, lat DOUBLE, lon DOUBLE)
        RETURN SELECT {", ".join(f"g.{c}" for c in columns)}, d.lat, d.lon
               FROM {geo_table} g LEFT JOIN (VALUES {point}) AS d(country_iso2, lat, lon)
                 ON g.country_iso2 = d.country_iso2
               WHERE g.{since} AND g.country_iso2 <> '{K.UNKNOWN_ISO2}'""")
    spark.sql(f"""CREATE OR REPLACE VIEW {database}.v_fraud_kpis_daily AS
        SELECT *, 100.0D * declined_total / nullif(transactions_total, 0) AS decline_rate_pct,
               100.0D * international_total / nullif(transactions_total, 0) AS international_rate_pct
        FROM {daily_table}""")
    spark.sql(f"""CREATE OR REPLACE VIEW {database}.v_gold_fraud_dashboard AS
        SELECT ds_day, events_total, transactions_total, approved_total, declined_total, amount_sum, amount_avg,
               risk_score_avg, international_total,
               try_divide(CAST(approved_total AS DOUBLE), CAST(transactions_total AS DOUBLE)) AS approval_rate,
               try_divide(CAST(declined_total AS DOUBLE), CAST(transactions_total AS DOUBLE)) AS decline_rate
        FROM {daily_table}""")
