"""Data-quality rules, grading, routing and audit.

Each rule is a native ``when`` inside one ``array`` of codes, so grading a
row is a projection: no shuffle, no Python.  Only the audit aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import event_ts_fallback, normalize_code, with_columns_once

_TS_TYPES = (T.TimestampType, T.TimestampNTZType)


def valid_countries(strict: bool) -> list[str]:
    # with aliases on, UK is rewritten to GB before the check, so GB is valid
    return list(K.VALID_COUNTRIES) if strict else list(K.VALID_COUNTRIES) + ["GB"]


def normalized_codes(df: DataFrame, strict: bool = False) -> dict[str, Column]:
    """The expressions of ``normalize_codes`` by column."""
    aliases = {} if strict else K.CODE_ALIASES
    return {name: normalize_code(F.col(name), aliases.get(name))
            for name in ("currency", "country", "channel", "status") if name in df.columns}


def normalize_codes(df: DataFrame, strict: bool = False) -> DataFrame:
    """upper(trim()) of currency, country, channel and status; unless
    ``strict``, producer spellings are mapped (UK -> GB, MOBILE_APP -> MOBILE)."""
    return df.withColumns(normalized_codes(df, strict))


# What a rule fires on; each helper takes a column name.  Three-valued logic is
# kept on purpose: a NULL passes ``_outside`` (``NOT IN`` is NULL) and fails
# ``_not_among``.

def _missing(name: str) -> Column:
    return F.coalesce(F.trim(F.col(name)), F.lit("")) == ""


def _outside(name: str, domain: list[str]) -> Column:
    return ~F.col(name).isin(*domain)


def _not_among(name: str, domain: list[str]) -> Column:
    return F.coalesce(_outside(name, domain), F.lit(True))


def _beyond(c: Column, low: Column | None = None, high: Column | None = None) -> Column:
    """Known, and below ``low`` or above ``high``."""
    sides = ([c < low] if low is not None else []) + ([c > high] if high is not None else [])
    return F.coalesce(_any(sides), F.lit(False))


def dq_rules(as_of: Column | None = None, strict: bool = False) -> list[tuple[str, Column]]:
    """(code, fires) per rule, in code order.  Expects normalised codes,
    ``event_ts_ts`` (parsed time), ``is_malformed_json`` and ``raw_line``.

    A NULL currency or country passes, a NULL channel or status fails.
    """
    latest = (as_of if as_of is not None else F.current_timestamp()) + F.expr(K.FUTURE_TOLERANCE)
    amount, time = F.col("amount"), F.col("event_ts_ts")
    fires = {
        "MALFORMED_JSON": F.col("raw_line").isNotNull() & F.col("is_malformed_json"),
        **{f"MISSING_{name.upper()}": _missing(name) for name in ("event_id", "transaction_id", "user_id")},
        "INVALID_EVENT_TS": time.isNull(),
        "MISSING_AMOUNT": amount.isNull(),
        "AMOUNT_NON_POSITIVE": F.coalesce(amount <= 0, F.lit(False)),
        "INVALID_CURRENCY": _outside("currency", K.VALID_CURRENCIES),
        "INVALID_COUNTRY": _outside("country", valid_countries(strict)),
        "INVALID_CHANNEL": _not_among("channel", K.VALID_CHANNELS),
        "INVALID_STATUS": _not_among("status", K.VALID_STATUS),
        "RISK_SCORE_OUT_OF_RANGE": _beyond(F.col("risk_score"), F.lit(0), F.lit(1)),
        "EVENT_TS_IN_FUTURE": _beyond(time, high=latest),
    }
    return [(code, fires[code]) for code in K.DQ_CODES]


def validate(df: DataFrame, as_of: Column | None = None, strict: bool = False) -> DataFrame:
    """Normalise codes, parse the event time, attach ``dq_errors``,
    ``dq_hard_errors`` and ``dq_status`` (BAD / WARN / GOOD) and ``ds_day``.

    ``strict=True`` reproduces the original lists and ISO-only time parsing.
    """
    out = normalize_codes(df, strict)
    ts_type = df.schema["event_ts"].dataType
    if isinstance(ts_type, _TS_TYPES):
        # already typed: no text parsing (which the optimizer may otherwise
        # copy into every pushed-down filter that depends on it)
        ts = F.col("event_ts").cast("timestamp")
    elif strict:
        ts = F.try_to_timestamp(F.col("event_ts").cast("string"))
    else:
        # each candidate is parsed before the choice: a bad first one does not
        # hide a good second one
        ts = event_ts_fallback(df, [c for c in ("event_ts", "event_time") if c in df.columns])
    extra = {}
    if "is_malformed_json" not in out.columns:
        extra["is_malformed_json"] = F.lit(False)
    if "raw_line" not in out.columns:
        extra["raw_line"] = F.lit(None).cast("string")
    out = out.withColumns(extra)
    # the text time parser runs once per row (not once per rule referencing it)
    out = out.withColumn("event_ts_ts", ts) if isinstance(ts_type, _TS_TYPES) else \
        with_columns_once(out, {"event_ts_ts": ts})
    rules = dq_rules(as_of, strict)
    # The grade is decided on the rule predicates (short-circuit booleans),
    # not on the code arrays, and computed once per row: routing filters
    # (``dq_status IN ...``) stay above it instead of being pushed down with
    # a copy of every rule (ahead of any repartition of a narrow input).
    out = with_columns_once(out, {"dq_status": grade(rules)})

    def codes(which: list[tuple[str, Column]]) -> Column:
        # a GOOD row has none: its array is not filtered
        fired = F.array_compact(F.array(*[F.when(fires, F.lit(code)) for code, fires in which]))
        return F.when(F.col("dq_status") == "GOOD", F.array().cast("array<string>")).otherwise(fired)

    hard = [(code, fires) for code, fires in rules if code in K.HARD_ERRORS]
    own = {"ds_day": F.to_date("event_ts_ts"), "dq_errors": codes(rules), "dq_hard_errors": codes(hard)}
    return out.select(*[c for c in out.columns if c not in (*own, "dq_status")],
                      *[c.alias(n) for n, c in own.items()], "dq_status")


def grade(rules: list[tuple[str, Column]]) -> Column:
    """BAD if a hard rule fires, WARN if any other rule fires, else GOOD
    (a rule whose predicate is NULL does not fire)."""
    hard_any = _any([F.coalesce(fires, F.lit(False)) for code, fires in rules if code in K.HARD_ERRORS])
    soft_any = _any([F.coalesce(fires, F.lit(False)) for code, fires in rules if code not in K.HARD_ERRORS])
    return F.when(hard_any, F.lit("BAD")).when(soft_any, F.lit("WARN")).otherwise(F.lit("GOOD"))


def _any(conds: list[Column]) -> Column:
    out = F.lit(False)
    for c in conds:
        out = out | c
    return out


def good_rows(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("dq_status").isin("GOOD", "WARN"))


def bad_rows(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("dq_status") == "BAD")


# --- fixed values: layout of the quarantine ----------------------------------
QUARANTINE_COLUMNS = ["ingestion_ts", "source_file", "raw_line", "dq_status", "dq_errors",
                      "dq_hard_errors", "event_id", "transaction_id", "user_id", "event_ts", "ds_day"]


def quarantine_view(validated: DataFrame, keep: tuple = ()) -> DataFrame:
    """BAD rows in the quarantine layout (raw line kept for replay)."""
    v = validated
    for c in ("ingestion_ts", "source_file"):
        if c not in v.columns:
            v = v.withColumn(c, F.lit(None).cast("timestamp" if c == "ingestion_ts" else "string"))
    return bad_rows(v).select(*[F.col(c).cast("string").alias(c) if c == "event_ts" else F.col(c)
                                for c in QUARANTINE_COLUMNS], *keep)


def audit(validated: DataFrame) -> DataFrame:
    """Rows per (ds_day, dq_status); a NULL day stays its own group.
    Partial aggregation before the shuffle: a hot day costs one row per task."""
    return validated.groupBy("ds_day", "dq_status").agg(F.count(F.lit(1)).alias("records"))


def error_counts(validated: DataFrame) -> DataFrame:
    """Rows per (ds_day, error code): one exploded row per event and code."""
    return (validated.select("ds_day", F.explode("dq_errors").alias("dq_error"))
            .groupBy("ds_day", "dq_error").agg(F.count(F.lit(1)).alias("records")))
