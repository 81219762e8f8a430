"""Event-time parsing.  All results are TIMESTAMP interpreted in the session
zone, which the library pins to UTC (``session.LAKE_CONF``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# epoch values at or above this are milliseconds, below it seconds
MILLIS_FROM = 10**12
# first second after year 9999; a number from there on is not a time
SECONDS_END = 253402300800
BR_FORMAT = "dd/MM/yyyy HH:mm:ss"


def parse_event_ts(c: Column) -> Column:
    """Digits -> epoch (>= 10^12 millis, else seconds) up to year 9999; else
    ``dd/MM/yyyy HH:mm:ss``; else ISO-8601.  Anything else is NULL."""
    s = c.cast("string")
    n = F.when(s.rlike(r"^[0-9]+$"), s.try_cast("long"))
    millis = F.when(n >= F.lit(MILLIS_FROM), n).otherwise(F.try_multiply(n, F.lit(1000)))
    epoch = F.when(millis < F.lit(SECONDS_END) * 1000, F.timestamp_millis(millis))
    # a text that the format cannot fit costs an exception: only those with its mark are tried
    br = F.when(s.contains("/"), F.try_to_timestamp(s, F.lit(BR_FORMAT)))
    return F.coalesce(epoch, br, F.try_to_timestamp(s))


def _as_timestamp(df: DataFrame, name: str) -> Column | None:
    if name not in df.columns:
        return None
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("timestamp")
    return parse_event_ts(F.col(name))


def ingest_ts(df: DataFrame, default: Column | None = None) -> Column:
    """Ingest time from ``ingest_time``, else ``ingest_timestamp``, else
    ``default`` (the job's ``as_of``; ``current_timestamp()`` if not given)."""
    for name in ("ingest_time", "ingest_timestamp"):
        c = _as_timestamp(df, name)
        if c is not None:
            return c
    return default if default is not None else F.current_timestamp()


def event_ts_fallback(df: DataFrame, names=("event_ts", "event_time", "ingest_ts")) -> Column:
    """First parsable time over ``event_ts`` -> ``event_time`` -> ``ingest_ts``."""
    cands = [c for c in (_as_timestamp(df, n) for n in names) if c is not None]
    if not cands:
        raise ValueError(f"no event time column among {list(names)}")
    return F.coalesce(*cands)


def day_parts(day: Column) -> dict[str, Column]:
    """Partition columns of a day: the year, and month and day as two digits."""
    return {"year": F.year(day), "month": F.date_format(day, "MM"), "day": F.date_format(day, "dd")}


def to_utc_ntz(c: Column) -> Column:
    """Zone-free wall-clock value of a UTC timestamp (for comparisons and
    outputs that must not depend on the reader's zone)."""
    return c.cast("timestamp_ntz")
