"""Small dimensions with a fixed, proven size (safe to broadcast)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import ip_key


def dim_country_latlon(spark: SparkSession) -> DataFrame:
    """Country coordinates: country_iso2, lat, lon (4 rows)."""
    rows = ", ".join(f"('{c}', CAST({lat!r} AS DOUBLE), CAST({lon!r} AS DOUBLE))" for c, lat, lon in K.COUNTRY_LATLON)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(country_iso2, lat, lon)")


# --- fixed values: test address ranges (FIXTURES.md section 9) -------------
# (first address, last address, country_name, country_iso2, latitude, longitude)
TEST_ADDRESS_RANGES = [
    ("1.0.0.0", "39.255.255.255", "Brazil", "BR", -1.4235E1, -5.19253E1),
    ("40.0.0.0", "79.255.255.255", "United States", "US", 3.70902E1, -9.57129E1),
    ("80.0.0.0", "109.255.255.255", "United Kingdom", "GB", 5.53781E1, -3.436E0),
    ("110.0.0.0", "139.255.255.255", "Argentina", "AR", -3.84161E1, -6.36167E1),
    ("2001:db8::", "2001:db8:0:ffff:ffff:ffff:ffff:ffff", "Brazil", "BR", -1.4235E1, -5.19253E1),
    ("2001:db8:1::", "2001:db8:7f:ffff:ffff:ffff:ffff:ffff", "United States", "US", 3.70902E1, -9.57129E1),
    ("2a00::", "2a0f:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "United Kingdom", "GB", 5.53781E1, -3.436E0),
]


def address_ranges(spark: SparkSession, rows=None) -> DataFrame:
    """Ranges of addresses (disjoint, inclusive, either family) to country,
    their ends as ordered keys.  In production give ``range_join`` a real
    table whose ends went through ``ip_key``; this builds the test table."""
    rows = rows or TEST_ADDRESS_RANGES
    vals = ", ".join(f"('{a}', '{b}', '{n}', '{c}', CAST({lat!r} AS DOUBLE), CAST({lon!r} AS DOUBLE))"
                     for a, b, n, c, lat, lon in rows)
    table = spark.sql(f"SELECT * FROM VALUES {vals} AS t(ip_start, ip_end, country_name, country_iso2, latitude, longitude)")
    return table.withColumns({c: ip_key(F.col(c)) for c in ("ip_start", "ip_end")})
