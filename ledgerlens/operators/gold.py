"""Gold marts over silver events.

``gold_base`` repairs and normalises whatever silver layout it is given
(column-presence dispatch, ``try_cast``), then every mart is one hash
aggregate keyed by the event day (``ds_day``, derived from the event time,
so a multi-day batch is safe).  All measures are algebraic (count, sum, avg,
min, max), so Spark aggregates partially before the shuffle and a hot day or
merchant costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import (boolish_to_int, event_ts_fallback, first_present, is_international,
                         merchant_struct, safe_col)


def gold_base(silver: DataFrame, strict: bool = False) -> DataFrame:
    """Silver rows with the normalised columns every mart uses.

    Status: ``approved`` then ``approved_int`` (boolean-like text); unless
    ``strict``, a row with neither falls back to the ``status`` text, so
    producer events that only carry ``status`` are not UNKNOWN.
    """
    df = silver.withColumn("event_ts", event_ts_fallback(silver)).where(F.col("event_ts").isNotNull())
    df = df.withColumn("merchant_norm", merchant_struct(df))
    approved = boolish_to_int(first_present(df, ["approved", "approved_int"], "string"))
    if not strict and "status" in df.columns:
        st = F.upper(F.trim(F.col("status").cast("string")))
        approved = F.coalesce(approved, F.when(st == "APPROVED", 1).when(st == "DECLINED", 0))
    mcc_names = ["mcc", "merchant_mcc"]
    mcc = first_present(df, mcc_names, "string")
    if not strict:
        mcc = F.coalesce(mcc, F.col("merchant_norm.mcc"))
    df = df.withColumns({
        "approved_norm": approved,
        "amount_num": first_present(df, ["amount_num", "amount_double", "amount"], "double"),
        "risk_score_num": first_present(df, ["risk_score", "risk_score_int"], "double"),
        "is_international_num": is_international(
            first_present(df, ["is_international", "is_international_int"], "string")),
        "ds_day": F.to_date("event_ts"),
        "event_hour": F.hour("event_ts"),
        "day_of_week": F.date_format("event_ts", "E"),
        "channel": F.coalesce(safe_col(df, "channel", "string"), F.lit("UNKNOWN")),
        "decline_reason": F.coalesce(safe_col(df, "decline_reason", "string"), F.lit("UNKNOWN")),
        "merchant_id_norm": F.coalesce(F.col("merchant_norm.merchant_id"), safe_col(df, "merchant_id", "string")),
        "merchant_country": F.col("merchant_norm.country"),
        "merchant_city": F.col("merchant_norm.city"),
        "merchant_mcc": mcc,
    })
    a = F.col("approved_norm")
    return df.withColumns({
        "is_approved": F.when(a == 1, 1).otherwise(0),
        "is_declined": F.when(a == 0, 1).otherwise(0),
        "status": F.when(a == 1, "APPROVED").when(a == 0, "DECLINED").otherwise("UNKNOWN"),
    })


def _total() -> Column:
    return F.count(F.lit(1)).alias("events_total")


def _declined() -> Column:
    return F.sum("is_declined").alias("events_declined")


def _rate() -> Column:
    return F.try_divide(F.sum("is_declined"), F.count(F.lit(1))).alias("decline_rate")


def _standard(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy("ds_day", *keys).agg(
        _total(), _declined(), _rate(),
        F.sum("amount_num").alias("amount_sum"),
        F.avg("risk_score_num").alias("risk_score_avg"))


def kpis_daily(base: DataFrame) -> DataFrame:
    return base.groupBy("ds_day").agg(
        _total(),
        F.sum("is_approved").alias("events_approved"),
        _declined(), _rate(),
        F.sum("amount_num").alias("amount_sum"),
        F.avg("amount_num").alias("amount_avg"),
        F.avg("risk_score_num").alias("risk_score_avg"),
        F.sum("is_international_num").alias("international_events"))


def by_region(base: DataFrame) -> DataFrame:
    return _standard(base, ["merchant_country", "merchant_city"])


def by_channel(base: DataFrame) -> DataFrame:
    return _standard(base, ["channel"])


def by_merchant(base: DataFrame) -> DataFrame:
    return _standard(base, ["merchant_id_norm"])


def by_payment_method(base: DataFrame) -> DataFrame:
    return _standard(base, [F.coalesce(safe_col(base, "payment_method", "string"),
                                       F.lit("UNKNOWN")).alias("payment_method")])


def hourly(base: DataFrame) -> DataFrame:
    return _standard(base, ["event_hour", "day_of_week"])


def by_decline_reason(base: DataFrame) -> DataFrame:
    return base.groupBy("ds_day", "decline_reason").agg(_total(), _declined(), _rate())


def top_merchants(base: DataFrame, n: int = K.TOP_N_MERCHANTS) -> DataFrame:
    """Top ``n`` merchants per day by declines, then volume, then id.

    ``row_number`` + filter plans as a partial ``WindowGroupLimit`` before the
    shuffle on day, so each map task forwards at most ``n`` rows per day and
    a day never gathers all of its merchants in one task."""
    w = Window.partitionBy("ds_day").orderBy(F.desc("events_declined"), F.desc("events_total"),
                                             F.asc_nulls_first("merchant_id_norm"))
    return (by_merchant(base).withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= F.lit(int(n))))


def events_daily_wide(base: DataFrame) -> DataFrame:
    """The wide daily mart (distinct cards, min/max amount, max risk)."""
    card = safe_col(base, "card_id", "string")
    return base.groupBy("ds_day").agg(
        _total(),
        F.count(F.lit(1)).alias("transactions_total"),
        F.count_distinct(card).alias("distinct_cards"),
        F.sum("is_approved").alias("approved_total"),
        F.sum("is_declined").alias("declined_total"),
        F.avg("amount_num").alias("amount_avg"),
        F.min("amount_num").alias("amount_min"),
        F.max("amount_num").alias("amount_max"),
        F.sum("amount_num").alias("amount_sum"),
        F.avg("risk_score_num").alias("risk_score_avg"),
        F.max("risk_score_num").alias("risk_score_max"),
        F.sum("is_international_num").alias("international_total"))


def cards_daily(base: DataFrame, log_k: int = 12) -> DataFrame:
    """Distinct cards of each day, exactly and as a sketch that can be merged:
    exact counts of days say nothing about a month, sketches do.  A sketch takes
    about ``2 ** log_k`` bytes at most and is off by about ``1 / sqrt(2 ** log_k)``
    (1.6 % at 12)."""
    card = safe_col(base, "card_id", "string")
    return base.groupBy("ds_day").agg(F.count_distinct(card).alias("distinct_cards"),
                                      F.hll_sketch_agg(card, F.lit(log_k)).alias("cards_sketch"))


def cards_over(daily: DataFrame, period: str) -> DataFrame:
    """Distinct cards of each week, month, quarter or year from the days'
    sketches; the events are not read again."""
    start = F.to_date(F.date_trunc(period, F.col("ds_day"))).alias("period_start")
    return daily.groupBy(start).agg(F.hll_sketch_estimate(F.hll_union_agg("cards_sketch")).alias("distinct_cards"))


def kpis_by_event_date(base: DataFrame) -> DataFrame:
    """Five-column KPI table keyed by event date (names as in its DDL)."""
    return base.groupBy(F.col("ds_day").alias("event_date")).agg(
        F.count(F.lit(1)).alias("total_transacoes"),
        F.sum("is_approved").alias("total_aprovadas"),
        F.sum("is_declined").alias("total_negadas"),
        F.avg("risk_score_num").alias("media_risk_score"))


def daily_by_type(base: DataFrame) -> DataFrame:
    et = F.coalesce(safe_col(base, "event_type", "string"), F.lit("UNKNOWN")).alias("event_type")
    return base.groupBy("ds_day", et).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("amount_num").alias("total_amount"))


def events_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("events_total"))


MARTS = {
    "kpis_daily": kpis_daily,
    "by_region": by_region,
    "by_channel": by_channel,
    "by_merchant": by_merchant,
    "top_merchants": top_merchants,
    "hourly": hourly,
    "by_decline_reason": by_decline_reason,
    "by_payment_method": by_payment_method,
    "events_daily_wide": events_daily_wide,
}


# Key sets of the marts that share algebraic measures; one GROUPING SETS
# aggregate computes them all in a single pass (Expand, then partial
# aggregation, then one shuffle).
MART_KEYS = {
    "kpis_daily": ["ds_day"],
    "by_region": ["ds_day", "merchant_country", "merchant_city"],
    "by_channel": ["ds_day", "channel"],
    "by_merchant": ["ds_day", "merchant_id_norm"],
    "hourly": ["ds_day", "event_hour", "day_of_week"],
    "by_decline_reason": ["ds_day", "decline_reason"],
    "by_payment_method": ["ds_day", "payment_method"],
}
# extra set feeding the wide mart's distinct card count
CARD_KEYS = ["ds_day", "card_id"]


def marts_one_pass(base: DataFrame) -> tuple[DataFrame, dict]:
    """All marts of ``MART_KEYS`` from one aggregate.

    Also yields the wide daily mart: min/max are algebraic, and the distinct
    card count is the number of (day, card) groups of one more set.
    Returns the combined aggregate (small: one row per group of every set;
    persist it when several marts are written) and a function per mart that
    selects its rows and columns.  ``grouping_id`` tells the sets apart, so a
    real NULL key is never confused with a rolled-up one."""
    df = base.withColumns({
        "payment_method": F.coalesce(safe_col(base, "payment_method", "string"), F.lit("UNKNOWN")),
        "card_id": safe_col(base, "card_id", "string")})
    key_sets = list(MART_KEYS.values()) + [CARD_KEYS]
    all_keys = list(dict.fromkeys(k for ks in key_sets for k in ks))
    agg = df.groupingSets([[F.col(k) for k in ks] for ks in key_sets], *all_keys).agg(
        F.grouping_id(*all_keys).alias("_gid"),
        F.count(F.lit(1)).alias("events_total"),
        F.sum("is_approved").alias("events_approved"),
        F.sum("is_declined").alias("events_declined"),
        F.sum("amount_num").alias("amount_sum"),
        F.avg("amount_num").alias("amount_avg"),
        F.avg("risk_score_num").alias("risk_score_avg"),
        F.sum("is_international_num").alias("international_events"),
        F.min("amount_num").alias("amount_min"),
        F.max("amount_num").alias("amount_max"),
        F.max("risk_score_num").alias("risk_score_max"))
    rate = F.try_divide(F.col("events_declined"), F.col("events_total")).alias("decline_rate")
    standard = ["events_total", "events_declined", rate, "amount_sum", "risk_score_avg"]
    cols = {
        "kpis_daily": ["events_total", "events_approved", "events_declined", rate, "amount_sum", "amount_avg",
                       "risk_score_avg", "international_events"],
        "by_decline_reason": ["events_total", "events_declined", rate],
    }

    def gid(keys):
        # bit i (from the left, highest first) is 1 when key i is rolled up
        return sum(1 << (len(all_keys) - 1 - i) for i, k in enumerate(all_keys) if k not in keys)

    def pick(name):
        keys = MART_KEYS[name]
        return lambda combined: combined.where(F.col("_gid") == gid(keys)).select(*keys, *cols.get(name, standard))

    def wide(combined):
        day = combined.where(F.col("_gid") == gid(MART_KEYS["kpis_daily"]))
        cards = (combined.where((F.col("_gid") == gid(CARD_KEYS)) & F.col("card_id").isNotNull())
                 .groupBy("ds_day").agg(F.count(F.lit(1)).alias("distinct_cards")))
        return day.join(cards, "ds_day", "left").select(
            "ds_day", "events_total", F.col("events_total").alias("transactions_total"),
            F.coalesce("distinct_cards", F.lit(0)).alias("distinct_cards"),
            F.col("events_approved").alias("approved_total"), F.col("events_declined").alias("declined_total"),
            "amount_avg", "amount_min", "amount_max", "amount_sum", "risk_score_avg", "risk_score_max",
            F.col("international_events").alias("international_total"))

    picks = {name: pick(name) for name in MART_KEYS}
    picks["events_daily_wide"] = wide
    return agg, picks
