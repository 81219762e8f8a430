"""Stable pseudo-country for reporting when no geo lookup is available."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def stable_bucket(key: Column, n: int) -> Column:
    """0..n-1 from the first 32 bits of md5(key); identical in any engine
    that has md5 (unlike xxhash64, whose seed differs between engines)."""
    h = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(n))


def country_surrogate(event_id: Column, is_international_int: Column) -> Column:
    """``BR`` for domestic events, else one of US/AR/GB chosen by the id."""
    arr = F.array(*[F.lit(c) for c in K.SURROGATE_COUNTRIES])
    return (F.when(is_international_int == 0, F.lit(K.DOMESTIC_COUNTRY))
            .otherwise(F.element_at(arr, (stable_bucket(event_id, len(K.SURROGATE_COUNTRIES)) + 1).cast("int"))))
