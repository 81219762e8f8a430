"""Column -> Column helpers.  Native Spark expressions only (no Python UDFs),
so every helper stays inside whole-stage codegen and works unchanged in
batch and streaming plans."""

from .columns import first_present, safe_col, with_columns_once
from .hashing import country_surrogate
from .json import MERCHANT_SCHEMA, merchant_struct, unglue_fragments
from .network import ip_key, ipv4_to_long
from .text import (boolish_to_int, clean_amount, country_iso2, country_name,
                   is_international, normalize_code, risk_bucket)
from .timestamps import day_parts, event_ts_fallback, ingest_ts, parse_event_ts, to_utc_ntz

__all__ = [
    "MERCHANT_SCHEMA", "boolish_to_int", "clean_amount", "country_iso2", "country_name",
    "country_surrogate", "day_parts", "event_ts_fallback", "first_present", "ingest_ts", "ip_key", "ipv4_to_long",
    "is_international", "merchant_struct", "normalize_code", "parse_event_ts", "risk_bucket",
    "safe_col", "to_utc_ntz", "unglue_fragments", "with_columns_once",
]
