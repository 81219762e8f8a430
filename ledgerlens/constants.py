"""Fixed values.

These must equal the values of the jobs and views being reproduced; they are
stated here once, in their natural order, and used everywhere else by name.
"""

# --- fixed values: data-quality domains (validation job) -------------------
VALID_CURRENCIES = ["BRL", "USD", "EUR", "GBP", "ARS"]
VALID_COUNTRIES = ["BR", "US", "UK", "AR"]
VALID_CHANNELS = ["WEB", "POS", "ECOMMERCE", "MOBILE", "API"]
VALID_STATUS = ["APPROVED", "DECLINED"]

# --- fixed values: data-quality error codes, in rule order ------------------
DQ_CODES = [
    "MALFORMED_JSON",
    "MISSING_EVENT_ID",
    "MISSING_TRANSACTION_ID",
    "MISSING_USER_ID",
    "INVALID_EVENT_TS",
    "MISSING_AMOUNT",
    "AMOUNT_NON_POSITIVE",
    "INVALID_CURRENCY",
    "INVALID_COUNTRY",
    "INVALID_CHANNEL",
    "INVALID_STATUS",
    "RISK_SCORE_OUT_OF_RANGE",
    "EVENT_TS_IN_FUTURE",
]
# every code except RISK_SCORE_OUT_OF_RANGE is hard (BAD); that one only WARNs
HARD_ERRORS = [c for c in DQ_CODES if c != "RISK_SCORE_OUT_OF_RANGE"]
FUTURE_TOLERANCE = "INTERVAL 5 MINUTES"

# --- fixed values: boolean-like text ----------------------------------------
TRUTHY = ["true", "1", "yes", "y", "t"]
FALSY = ["false", "0", "no", "n", "f"]

# --- fixed values: country columns, junk tokens and names --------------------
COUNTRY_CANDIDATES = ["country_iso2", "country", "country_code", "countryCode", "country_iso"]
COUNTRY_JUNK = ["", "NULL", "UNK", "UNKNOWN", "N/A"]
COUNTRY_NAMES = {
    "BR": "Brazil",
    "US": "United States",
    "GB": "United Kingdom",
    "AR": "Argentina",
}

# --- fixed values: country coordinate dimension (iso2, lat, lon) -----------
COUNTRY_LATLON = [
    ("BR", -1.4235E1, -5.19253E1),
    ("US", 3.70902E1, -9.57129E1),
    ("GB", 5.53781E1, -3.436E0),
    ("AR", -3.84161E1, -6.36167E1),
]

# --- fixed values: pseudo-country buckets for international events ---------
SURROGATE_COUNTRIES = ["US", "AR", "GB"]
DOMESTIC_COUNTRY = "BR"

# --- fixed values: geo fallbacks of the keep-unknown variant ----------------
UNKNOWN_ISO2 = "UNK"
UNKNOWN_NAME = "Unknown"

# --- our choices (not from the reproduced jobs) ----------------------------
# Alias table applied before validation unless strict=True: the event
# producer writes UK and MOBILE_APP, the lists and dimensions use GB/MOBILE.
CODE_ALIASES = {"country": {"UK": "GB"}, "channel": {"MOBILE_APP": "MOBILE"}}
# Risk buckets: LOW < 0.40 <= MEDIUM <= 0.75 < HIGH (0.75 is the producer's cut).
RISK_MEDIUM_FROM = 0.40
RISK_HIGH_ABOVE = 0.75
TOP_N_MERCHANTS = 20
GEO_LOOKBACK_DAYS = 90
