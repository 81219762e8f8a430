"""Independent DuckDB SQL for every registered query.

Written from the semantics, not generated from the Spark plans: the CTEs
below rebuild the fixture adapters, the validation rules, the canonical
silver rows and the gold base in plain SQL, and each query's SQL selects
from them.  Doubles are rounded to 6 places on both sides (engines differ in
the last bits of float sums); integer sums are cast to BIGINT (DuckDB sums
to HUGEINT); timestamps are zone-free.
"""

from __future__ import annotations

from . import constants as K

AS_OF_TS = "TIMESTAMP '2024-01-31 00:00:00'"
AS_OF_DATE = "DATE '2024-01-31'"


def _lst(vals) -> str:
    return ", ".join(f"'{v}'" for v in vals)


TRUTHY, FALSY = _lst(K.TRUTHY), _lst(K.FALSY)


def merchant_sql(i: str = "event_id") -> str:
    return f"""CASE {i} % 4
   WHEN 0 THEN concat('{{"city":"', CASE {i} % 3 WHEN 0 THEN 'Sao Paulo' WHEN 1 THEN 'Miami' ELSE 'London' END,
     '","country":"', CASE {i} % 3 WHEN 0 THEN 'BR' WHEN 1 THEN 'US' ELSE 'GB' END,
     '","mcc":"', CAST(5000 + {i} % 9 AS VARCHAR), '","merchant_id":"m_', CAST({i} % 50 AS VARCHAR), '"}}')
   WHEN 1 THEN concat('m_', CAST({i} % 50 AS VARCHAR))
   WHEN 2 THEN '{{"city":"Recife"}}'
   ELSE CASE WHEN {i} % 28 = 3 THEN 'shop }}{{ annex' END END"""


PAYMENTS = f"""payments AS (
SELECT CASE WHEN event_id % 211 = 0 THEN NULL ELSE concat('evt_', CAST(event_id - CASE WHEN event_id % 97 = 1 THEN 1 WHEN event_id % 101 = 7 AND event_id >= 700 THEN 700 ELSE 0 END AS VARCHAR)) END AS event_id,
 concat('txn_', CAST(event_id AS VARCHAR)) AS transaction_id,
 concat('user_', CAST(user_id AS VARCHAR)) AS user_id,
 concat('card_', CAST(user_id % 61 AS VARCHAR)) AS card_id,
 concat('m_', CAST(event_id % 50 AS VARCHAR)) AS merchant_id,
 CASE WHEN event_id % 173 = 0 THEN -value WHEN event_id % 179 = 0 THEN NULL
   WHEN event_id % 223 = 0 THEN CAST(10000000 + event_id AS DOUBLE) WHEN event_id % 227 = 0 THEN CAST(1 + event_id % 9 AS DOUBLE) / 10000 ELSE value END AS amount,
 CASE event_id % 4 WHEN 0 THEN 'BRL' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' ELSE 'ARS' END AS currency,
 CASE event_id % 6 WHEN 0 THEN 'CREDIT_CARD' WHEN 1 THEN 'DEBIT_CARD' WHEN 2 THEN 'PIX' WHEN 3 THEN 'BOLETO' WHEN 4 THEN 'APPLE_PAY' ELSE 'GOOGLE_PAY' END AS payment_method,
 CASE event_type WHEN 'view' THEN 'web' WHEN 'click' THEN ' MOBILE ' WHEN 'purchase' THEN 'POS' WHEN 'signup' THEN 'ECOMMERCE' ELSE 'MOBILE_APP' END AS channel,
 CASE WHEN event_id % 191 = 0 THEN 'XX' ELSE CASE event_id % 4 WHEN 0 THEN 'BR' WHEN 1 THEN 'US' WHEN 2 THEN 'UK' ELSE 'AR' END END AS country,
 CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 43 = 0 THEN 'unknown'
   WHEN event_id % 7 = 3 THEN concat('2001:DB8:', CAST(event_id % 5 AS VARCHAR), '::', CAST(user_id % 10 AS VARCHAR))
   WHEN event_id % 7 = 5 THEN concat('2a05:', CAST(user_id % 10 AS VARCHAR), '::1.2.3.4')
   ELSE concat(CASE WHEN event_id % 7 = 6 THEN '::ffff:' ELSE '' END, CAST(1 + user_id % 223 AS VARCHAR), '.', CAST(event_id % 256 AS VARCHAR), '.0.', CAST(user_id % 256 AS VARCHAR)) END AS device_ip,
 CASE WHEN event_id % 199 = 0 THEN CAST(1.5 AS DOUBLE) ELSE CAST(event_id % 101 AS DOUBLE) / 100 END AS risk_score,
 CASE WHEN event_id % 4 = 0 THEN 0 ELSE 1 END AS is_international,
 CASE WHEN event_id % 101 > 75 THEN 'DECLINED' ELSE 'APPROVED' END AS status,
 CASE WHEN event_id % 101 > 75 THEN 'false' WHEN event_id % 13 = 0 THEN NULL ELSE 'yes' END AS approved,
 CASE WHEN event_id % 101 > 75 THEN CASE event_id % 3 WHEN 0 THEN 'INSUFFICIENT_FUNDS' WHEN 1 THEN 'SUSPECTED_FRAUD' ELSE 'LIMIT' END END AS decline_reason,
 event_type, ts AS event_ts, CAST(ts AS DATE) AS ds,
 {merchant_sql()} AS merchant,
 event_id AS src_id
FROM events)"""

UNTIDY = f"""untidy AS (
SELECT event_id,
 CASE event_id % 5
   WHEN 0 THEN CAST(1704067200 + event_id * 60 AS VARCHAR)
   WHEN 1 THEN concat(CAST(1704067200 + event_id * 60 AS VARCHAR), '123')
   WHEN 2 THEN concat(lpad(CAST(1 + event_id % 28 AS VARCHAR), 2, '0'), '/01/2024 ', lpad(CAST(event_id % 24 AS VARCHAR), 2, '0'), ':', lpad(CAST(event_id % 60 AS VARCHAR), 2, '0'), ':07')
   WHEN 3 THEN concat('2024-01-', lpad(CAST(1 + event_id % 28 AS VARCHAR), 2, '0'), 'T', lpad(CAST(event_id % 24 AS VARCHAR), 2, '0'), ':', lpad(CAST(event_id % 60 AS VARCHAR), 2, '0'), ':07Z')
   ELSE 'nope' END AS time_text,
 CASE event_id % 5
   WHEN 0 THEN concat('R$ 1.', lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0'), ',', lpad(CAST(event_id % 100 AS VARCHAR), 2, '0'))
   WHEN 1 THEN concat(CAST(event_id % 1000 AS VARCHAR), ',', lpad(CAST(event_id % 100 AS VARCHAR), 2, '0'))
   WHEN 2 THEN concat('  ', CAST(event_id % 1000 AS VARCHAR), '.', lpad(CAST(event_id % 100 AS VARCHAR), 2, '0'), ' ')
   WHEN 3 THEN concat('-', CAST(event_id % 1000 AS VARCHAR))
   ELSE 'abc' END AS amount_text,
 CASE event_id % 7 WHEN 0 THEN ' br ' WHEN 1 THEN 'N/A' WHEN 2 THEN '' WHEN 3 THEN 'BRAZIL' WHEN 4 THEN 'us' WHEN 5 THEN 'unk' END AS country_a,
 CASE event_id % 2 WHEN 0 THEN 'ar' ELSE 'GB ' END AS country_b,
 CASE event_id % 8 WHEN 0 THEN 'TRUE' WHEN 1 THEN ' no ' WHEN 2 THEN '1' WHEN 3 THEN '0' WHEN 4 THEN 'f' WHEN 5 THEN 'Y' WHEN 6 THEN 'maybe' END AS bool_text,
 {merchant_sql()} AS merchant,
 concat('{{"event_id":"evt_', CAST(event_id AS VARCHAR), '","amount":', CAST(event_id % 1000 AS VARCHAR), ',"nested":{{"k":1}}}}',
   CASE WHEN event_id % 10 = 0 THEN concat(' {{"event_id":"glued_', CAST(event_id AS VARCHAR), '","amount":1}}')
        WHEN event_id % 10 = 1 THEN concat('{{"event_id":"glued_', CAST(event_id AS VARCHAR), '"}}') ELSE '' END) AS raw_line
FROM events)"""

RANGES = """ranges AS (SELECT * FROM (VALUES
  (CAST(16777216 AS BIGINT), CAST(671088639 AS BIGINT), 'Brazil', 'BR', CAST(-1.4235E1 AS DOUBLE), CAST(-5.19253E1 AS DOUBLE)),
  (CAST(671088640 AS BIGINT), CAST(1342177279 AS BIGINT), 'United States', 'US', CAST(3.70902E1 AS DOUBLE), CAST(-9.57129E1 AS DOUBLE)),
  (CAST(1342177280 AS BIGINT), CAST(1845493759 AS BIGINT), 'United Kingdom', 'GB', CAST(5.53781E1 AS DOUBLE), CAST(-3.436E0 AS DOUBLE)),
  (CAST(1845493760 AS BIGINT), CAST(2348810239 AS BIGINT), 'Argentina', 'AR', CAST(-3.84161E1 AS DOUBLE), CAST(-6.36167E1 AS DOUBLE)),
  -- IPv6 ranges, by a number of their own below zero
  (CAST(-1 AS BIGINT), CAST(-1 AS BIGINT), 'Brazil', 'BR', CAST(-1.4235E1 AS DOUBLE), CAST(-5.19253E1 AS DOUBLE)),
  (CAST(-2 AS BIGINT), CAST(-2 AS BIGINT), 'United States', 'US', CAST(3.70902E1 AS DOUBLE), CAST(-9.57129E1 AS DOUBLE)),
  (CAST(-3 AS BIGINT), CAST(-3 AS BIGINT), 'United Kingdom', 'GB', CAST(5.53781E1 AS DOUBLE), CAST(-3.436E0 AS DOUBLE))
) AS t(ip_start, ip_end, country_name, country_iso2, latitude, longitude))"""

DIM = """dim AS (SELECT * FROM (VALUES ('BR', CAST(-1.4235E1 AS DOUBLE), CAST(-5.19253E1 AS DOUBLE)),
  ('US', CAST(3.70902E1 AS DOUBLE), CAST(-9.57129E1 AS DOUBLE)),
  ('GB', CAST(5.53781E1 AS DOUBLE), CAST(-3.436E0 AS DOUBLE)),
  ('AR', CAST(-3.84161E1 AS DOUBLE), CAST(-6.36167E1 AS DOUBLE))) AS t(country_iso2, lat, lon))"""


def parse_ts(s: str) -> str:
    n = f"(CASE WHEN regexp_full_match({s}, '[0-9]+') THEN TRY_CAST({s} AS BIGINT) END)"
    return (f"coalesce(CASE WHEN {n} >= 1000000000000 THEN (CASE WHEN {n} <= 253402300799999 "
            f"THEN make_timestamp({n} * 1000) END) WHEN {n} < 253402300800 THEN make_timestamp({n} * 1000000) END, "
            f"try_strptime({s}, '%d/%m/%Y %H:%M:%S'), TRY_CAST({s} AS TIMESTAMP))")


def clean_amount(s: str, strict: bool = False) -> str:
    s1 = f"regexp_replace(regexp_replace(CAST({s} AS VARCHAR), 'R\\$\\s*', '', 'g'), '\\s+', '', 'g')"
    if strict:
        s2 = f"CASE WHEN contains({s1}, ',') THEN replace(replace({s1}, '.', ''), ',', '.') ELSE {s1} END"
    else:
        s2 = (f"CASE WHEN contains({s1}, ',') AND regexp_matches({s1}, ',[^.]*$') "
              f"THEN replace(replace({s1}, '.', ''), ',', '.') "
              f"WHEN contains({s1}, ',') THEN replace({s1}, ',', '') ELSE {s1} END")
    plain = f"regexp_full_match(trim({s}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')"
    return (f"CASE WHEN {plain} THEN TRY_CAST(trim({s}) AS DOUBLE) "
            f"ELSE TRY_CAST(regexp_replace({s2}, '[^0-9.\\-]', '', 'g') AS DOUBLE) END")


def iso2(x: str) -> str:
    v = f"upper(trim({x}))"
    return f"CASE WHEN {v} NOT IN ({_lst(K.COUNTRY_JUNK)}) AND length({v}) = 2 THEN {v} END"


def boolish(x: str) -> str:
    v = f"lower(trim(CAST({x} AS VARCHAR)))"
    return f"CASE WHEN {v} IN ({TRUTHY}) THEN 1 WHEN {v} IN ({FALSY}) THEN 0 END"


def truthy01(x: str) -> str:
    return f"CASE WHEN lower(trim(CAST({x} AS VARCHAR))) IN ({TRUTHY}) THEN 1 ELSE 0 END"


def country_name(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} = '{c}' THEN '{n}'" for c, n in K.COUNTRY_NAMES.items()) + " END"


def _norm(src: str, ts_expr: str, malformed: str) -> str:
    codes = {
        "currency": "upper(trim(currency))",
        "country": "CASE WHEN upper(trim(country)) = 'UK' THEN 'GB' ELSE upper(trim(country)) END",
        "channel": "CASE WHEN upper(trim(channel)) = 'MOBILE_APP' THEN 'MOBILE' ELSE upper(trim(channel)) END",
        "status": "upper(trim(status))",
    }
    repl = ", ".join(f"{v} AS {k}" for k, v in codes.items())
    rules = [
        f"CASE WHEN {malformed} THEN 'MALFORMED_JSON' END",
        "CASE WHEN event_id IS NULL OR length(trim(event_id)) = 0 THEN 'MISSING_EVENT_ID' END",
        "CASE WHEN transaction_id IS NULL OR length(trim(transaction_id)) = 0 THEN 'MISSING_TRANSACTION_ID' END",
        "CASE WHEN user_id IS NULL OR length(trim(user_id)) = 0 THEN 'MISSING_USER_ID' END",
        "CASE WHEN event_ts_ts IS NULL THEN 'INVALID_EVENT_TS' END",
        "CASE WHEN amount IS NULL THEN 'MISSING_AMOUNT' END",
        "CASE WHEN amount IS NOT NULL AND amount <= 0 THEN 'AMOUNT_NON_POSITIVE' END",
        f"CASE WHEN NOT (currency IN ({_lst(K.VALID_CURRENCIES)})) THEN 'INVALID_CURRENCY' END",
        f"CASE WHEN NOT (country IN ({_lst(K.VALID_COUNTRIES + ['GB'])})) THEN 'INVALID_COUNTRY' END",
        f"CASE WHEN channel IS NULL OR NOT (channel IN ({_lst(K.VALID_CHANNELS)})) THEN 'INVALID_CHANNEL' END",
        f"CASE WHEN status IS NULL OR NOT (status IN ({_lst(K.VALID_STATUS)})) THEN 'INVALID_STATUS' END",
        "CASE WHEN risk_score IS NOT NULL AND (risk_score < 0 OR risk_score > 1) THEN 'RISK_SCORE_OUT_OF_RANGE' END",
        f"CASE WHEN event_ts_ts IS NOT NULL AND event_ts_ts > {AS_OF_TS} + INTERVAL 5 MINUTE THEN 'EVENT_TS_IN_FUTURE' END",
    ]
    hard = [r for r in rules if "RISK_SCORE_OUT_OF_RANGE" not in r]
    return f"""norm0 AS (SELECT * REPLACE ({repl}) FROM {src}),
norm1 AS (SELECT *, {ts_expr} AS event_ts_ts FROM norm0),
checked0 AS (SELECT *, CAST(event_ts_ts AS DATE) AS ds_day,
  concat_ws(',', {', '.join(rules)}) AS dq_errors,
  concat_ws(',', {', '.join(hard)}) AS dq_hard_errors FROM norm1),
checked AS (SELECT *, CASE WHEN dq_hard_errors <> '' THEN 'BAD' WHEN dq_errors <> '' THEN 'WARN' ELSE 'GOOD' END AS dq_status FROM checked0)"""


SILVER_BODY = f"""SELECT event_id, transaction_id, user_id, card_id, merchant_id, merchant, amount, currency,
  payment_method, channel, country, device_ip, risk_score, is_international, status, approved,
  decline_reason, event_type, event_ts_ts AS event_ts, ds_day, ds_day AS ds, dq_status, dq_errors,
  amount AS amount_double,
  coalesce({boolish('approved')}, CASE WHEN status = 'APPROVED' THEN 1 WHEN status = 'DECLINED' THEN 0 END) AS approved_int,
  {truthy01('is_international')} AS is_international_int,
  {iso2('country')} AS country_iso2
FROM checked WHERE dq_status <> 'BAD'"""

def _mj(field: str) -> str:
    return "CASE WHEN starts_with(merchant, '{') THEN json_extract_string(merchant, '$." + field + "') END"


BASE = f"""base AS (
SELECT s.*,
  coalesce({boolish("coalesce(approved, CAST(approved_int AS VARCHAR))")},
           CASE WHEN upper(trim(status)) = 'APPROVED' THEN 1 WHEN upper(trim(status)) = 'DECLINED' THEN 0 END) AS approved_norm,
  coalesce(amount_double, amount) AS amount_num,
  risk_score AS risk_score_num,
  {truthy01("coalesce(CAST(is_international AS VARCHAR), CAST(is_international_int AS VARCHAR))")} AS is_international_num,
  CAST(hour(event_ts) AS INTEGER) AS event_hour,
  strftime(event_ts, '%a') AS day_of_week,
  coalesce(channel, 'UNKNOWN') AS channel_g,
  coalesce(decline_reason, 'UNKNOWN') AS decline_reason_g,
  coalesce({_mj('merchant_id')}, merchant_id) AS merchant_id_norm,
  {_mj('country')} AS merchant_country,
  {_mj('city')} AS merchant_city,
  {_mj('mcc')} AS merchant_mcc
FROM silver s),
gbase AS (SELECT *, CASE WHEN approved_norm = 1 THEN 1 ELSE 0 END AS is_approved,
  CASE WHEN approved_norm = 0 THEN 1 ELSE 0 END AS is_declined FROM base)"""

# ---- bronze lines after un-glue and parse (see fixtures.bronze_lines) ----
BRONZE_PARSED = f"""lines AS (SELECT * FROM payments UNION ALL SELECT * FROM payments WHERE src_id % 10 = 0),
parsed AS (
SELECT src_id, is_malformed,
  CASE WHEN NOT is_malformed THEN event_id END AS event_id,
  CASE WHEN NOT is_malformed THEN transaction_id END AS transaction_id,
  CASE WHEN NOT is_malformed THEN user_id END AS user_id,
  CASE WHEN NOT is_malformed THEN card_id END AS card_id,
  CASE WHEN NOT is_malformed THEN merchant_id END AS merchant_id,
  CASE WHEN NOT is_malformed THEN merchant END AS merchant,
  CASE WHEN NOT is_malformed THEN amount END AS amount,
  CASE WHEN NOT is_malformed THEN currency END AS currency,
  CASE WHEN NOT is_malformed THEN payment_method END AS payment_method,
  CASE WHEN NOT is_malformed THEN channel END AS channel,
  CASE WHEN NOT is_malformed AND src_id % 5 = 0 THEN country END AS country,
  CASE WHEN NOT is_malformed AND src_id % 5 <> 0 THEN country END AS other_country,
  CASE WHEN NOT is_malformed AND src_id % 6 = 1 THEN CAST(4000 + src_id % 7 AS VARCHAR) END AS mcc,
  CASE WHEN NOT is_malformed THEN concat('{{"model":', CAST(src_id % 3 AS VARCHAR), '}}') END AS device,
  CASE WHEN NOT is_malformed AND src_id % 2 = 0 THEN concat('{{"k":1,"v":"a}}{{', CAST(src_id % 4 AS VARCHAR), '"}}') END AS metadata,
  CASE WHEN NOT is_malformed AND src_id % 166 = 0 THEN strftime(event_ts, '%Y-%m-%dT%H:%M:%SZ') END AS event_time,
  CAST(ds AS DATE) + CAST(CASE WHEN src_id % 31 = 0 THEN 1 ELSE 0 END AS INTEGER) AS bronze_day,
  CASE WHEN NOT is_malformed THEN device_ip END AS device_ip,
  CASE WHEN NOT is_malformed THEN risk_score END AS risk_score,
  CASE WHEN NOT is_malformed THEN is_international END AS is_international,
  CASE WHEN NOT is_malformed THEN status END AS status,
  CASE WHEN NOT is_malformed THEN approved END AS approved,
  CASE WHEN NOT is_malformed THEN decline_reason END AS decline_reason,
  CASE WHEN NOT is_malformed THEN event_type END AS event_type,
  CASE WHEN is_malformed THEN NULL WHEN src_id % 83 = 0 THEN 'not-a-time'
       ELSE strftime(event_ts, '%Y-%m-%dT%H:%M:%SZ') END AS event_ts
FROM (SELECT *, (src_id % 89 = 0 AND src_id % 10 <> 0) AS is_malformed FROM lines))"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


NORM_PAYMENTS = _norm("payments", "CAST(event_ts AS TIMESTAMP)", "FALSE")
NORM_BRONZE = _norm("parsed", f"coalesce({parse_ts('event_ts')}, {parse_ts('event_time')})", "is_malformed")
SILVER_P = f"silver AS ({SILVER_BODY})"
# from bronze: one more country field, and the fields that only raw events have
SILVER_B = "silver AS (" + SILVER_BODY.replace(
    f"{iso2('country')} AS country_iso2", f"coalesce({iso2('country')}, {iso2('other_country')}) AS country_iso2,\n"
    "  mcc, device, metadata, bronze_day") + ")"

# CTE chains
C_PAY = (PAYMENTS,)
C_VAL = (PAYMENTS, NORM_PAYMENTS)
C_SILVER = (PAYMENTS, NORM_PAYMENTS, SILVER_P)
C_BASE = (PAYMENTS, NORM_PAYMENTS, SILVER_P, BASE)
C_BRONZE = (PAYMENTS, BRONZE_PARSED)
C_BRONZE_VAL = (PAYMENTS, BRONZE_PARSED, NORM_BRONZE)
C_BRONZE_SILVER = (PAYMENTS, BRONZE_PARSED, NORM_BRONZE, SILVER_B)
DEDUP_SILVER = """dsilver AS (SELECT * FROM silver WHERE event_id IS NULL
  UNION ALL SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY event_id
  ORDER BY event_ts DESC, transaction_id DESC) AS rn FROM silver WHERE event_id IS NOT NULL) WHERE rn = 1)"""
C_BRONZE_DEDUP_BASE = (PAYMENTS, BRONZE_PARSED, NORM_BRONZE, SILVER_B, DEDUP_SILVER,
                       BASE.replace("FROM silver s", "FROM dsilver s"))


def r6(x: str) -> str:
    # same tie nudge as registry._finish
    return f"round(({x}) + 1e-9, 6)"


STD = f"""count(*) AS events_total, CAST(sum(is_declined) AS BIGINT) AS events_declined,
  {r6('sum(is_declined) / count(*)')} AS decline_rate, {r6('sum(amount_num)')} AS amount_sum,
  {r6('avg(risk_score_num)')} AS risk_score_avg"""

KPIS = f"""SELECT ds_day, count(*) AS events_total, CAST(sum(is_approved) AS BIGINT) AS events_approved,
  CAST(sum(is_declined) AS BIGINT) AS events_declined, {r6('sum(is_declined) / count(*)')} AS decline_rate,
  {r6('sum(amount_num)')} AS amount_sum, {r6('avg(amount_num)')} AS amount_avg,
  {r6('avg(risk_score_num)')} AS risk_score_avg, CAST(sum(is_international_num) AS BIGINT) AS international_events
FROM gbase GROUP BY ds_day"""

def wide_sql(rounded: bool = True) -> str:
    rr = r6 if rounded else (lambda x: x)
    return f"""SELECT ds_day, count(*) AS events_total, count(*) AS transactions_total,
  count(DISTINCT card_id) AS distinct_cards, CAST(sum(is_approved) AS BIGINT) AS approved_total,
  CAST(sum(is_declined) AS BIGINT) AS declined_total, {rr('avg(amount_num)')} AS amount_avg,
  {rr('min(amount_num)')} AS amount_min, {rr('max(amount_num)')} AS amount_max, {rr('sum(amount_num)')} AS amount_sum,
  {rr('avg(risk_score_num)')} AS risk_score_avg, {rr('max(risk_score_num)')} AS risk_score_max,
  CAST(sum(is_international_num) AS BIGINT) AS international_total
FROM gbase GROUP BY ds_day"""


WIDE = wide_sql(True)
WIDE_RAW = wide_sql(False)  # unrounded, for views computed on top

GEO_ENRICHED = """enriched AS (
SELECT s.* EXCLUDE (v4), r.country_name, r.country_iso2 AS geo_iso2, r.latitude, r.longitude FROM
 (SELECT *, CASE WHEN v4 IS NOT NULL THEN CAST(string_split(v4, '.')[1] AS BIGINT) * 16777216 + CAST(string_split(v4, '.')[2] AS BIGINT) * 65536
      + CAST(string_split(v4, '.')[3] AS BIGINT) * 256 + CAST(string_split(v4, '.')[4] AS BIGINT)
   WHEN lower(device_ip) LIKE '2001:db8:0:%' THEN -1 WHEN lower(device_ip) LIKE '2001:db8:%' THEN -2
   WHEN lower(device_ip) LIKE '2a05:%' THEN -3 END AS ip_num
  FROM (SELECT *, CASE WHEN regexp_full_match(device_ip, '(::ffff:)?[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+')
    THEN replace(device_ip, '::ffff:', '') END AS v4 FROM silver)) s
 LEFT JOIN ranges r ON s.ip_num BETWEEN r.ip_start AND r.ip_end)"""


def geo_daily_sql(keep_unknown: bool, rounded: bool = True) -> str:
    rr = r6 if rounded else (lambda x: x)
    if keep_unknown:
        src = f"(SELECT * REPLACE (coalesce(geo_iso2, '{K.UNKNOWN_ISO2}') AS geo_iso2, coalesce(country_name, '{K.UNKNOWN_NAME}') AS country_name) FROM enriched WHERE ds IS NOT NULL)"
    else:
        src = "(SELECT * FROM enriched WHERE ds IS NOT NULL AND geo_iso2 IS NOT NULL)"
    return f"""SELECT ds, country_name, geo_iso2 AS country_iso2, count(*) AS events_total, count(*) AS transactions_total,
  CAST(sum(approved_int) AS BIGINT) AS approved_total,
  CAST(sum(CASE WHEN approved_int = 0 THEN 1 ELSE 0 END) AS BIGINT) AS declined_total,
  {rr('sum(amount_double)')} AS amount_sum, {rr('avg(risk_score)')} AS risk_score_avg,
  CAST(sum(is_international_int) AS BIGINT) AS international_total
FROM {src} GROUP BY ds, country_name, geo_iso2"""


C_GEO = (PAYMENTS, NORM_PAYMENTS, SILVER_P, RANGES, GEO_ENRICHED)


# ----------------------------------------------------------- per query ---

def _std_by(keys_sel: str, keys_grp: str) -> str:
    return with_ctes(*C_BASE, body=f"SELECT ds_day, {keys_sel}, {STD} FROM gbase GROUP BY ds_day, {keys_grp}")


GEO_RAW = f"geo AS ({geo_daily_sql(True, rounded=False)})"
C_GEO_MART = C_GEO + (GEO_RAW,)
SINCE = f"{AS_OF_DATE} - INTERVAL 90 DAY"
PCT = f"""SELECT *, {r6('100.0 * declined_total / nullif(transactions_total, 0)')} AS decline_rate_pct,
  {r6('100.0 * international_total / nullif(transactions_total, 0)')} AS international_rate_pct"""
WIDE_PCT_BODY = f"""SELECT ds_day, events_total, transactions_total, distinct_cards, approved_total, declined_total,
  {r6('amount_avg')} AS amount_avg, {r6('amount_min')} AS amount_min, {r6('amount_max')} AS amount_max,
  {r6('amount_sum')} AS amount_sum, {r6('risk_score_avg')} AS risk_score_avg, {r6('risk_score_max')} AS risk_score_max,
  international_total,
  {r6('100.0 * declined_total / nullif(transactions_total, 0)')} AS decline_rate_pct,
  {r6('100.0 * international_total / nullif(transactions_total, 0)')} AS international_rate_pct FROM wide"""
ARRIVED = ("(SELECT CAST(ts AS DATE) + CAST(CASE WHEN event_id % 31 = 0 THEN 1 ELSE 0 END AS INTEGER) AS d "
           "FROM events)")
BRONZE_DAY = "(SELECT max(CAST(ts AS DATE)) FROM events)"
RISK_BUCKET = ("CASE WHEN risk_score IS NULL THEN NULL WHEN risk_score < 0.4 THEN 'LOW' "
               "WHEN risk_score <= 0.75 THEN 'MEDIUM' ELSE 'HIGH' END")
SURROGATE = ("CASE WHEN is_international_int = 0 THEN 'BR' ELSE "
             "['US', 'AR', 'GB'][1 + (('0x' || substr(md5(event_id), 1, 8))::BIGINT % 3)] END")
KPIS_BRONZE = with_ctes(*C_BRONZE_DEDUP_BASE, body=KPIS)


def _counts_by(keys: str, src: str, chain) -> str:
    return with_ctes(*chain, body=f"SELECT {keys}, count(*) AS records FROM {src} GROUP BY {keys}")


SILVER_READBACK = with_ctes(*C_BRONZE_SILVER, body=f"""SELECT transaction_id, event_id, bronze_day, ds_day,
  dq_status, dq_errors, {r6('amount')} AS amount, currency, channel, country, country_iso2, mcc, device, metadata,
  approved_int, {RISK_BUCKET} AS risk_bucket FROM silver""")
SILVER_UNKNOWN_FIELDS = with_ctes(*C_BRONZE_VAL, body="""SELECT sink, txn AS transaction_id, ds_day,
  CAST(substr(txn, 5) AS BIGINT) AS points, 't }{ ' || substr(txn, 5) AS tier, 'c' || substr(txn, 5) AS coupon,
  CASE WHEN NOT is_malformed THEN 'coupon,loyalty' END AS undeclared FROM (
  SELECT *, CASE WHEN dq_status = 'BAD' THEN 'quarantine' ELSE 'silver' END AS sink,
    CASE WHEN NOT is_malformed THEN transaction_id END AS txn FROM checked)""")
BRONZE_FRAGMENTS = """fragments AS (SELECT event_id, fragment_idx, fragment FROM (
  SELECT event_id, unnest(range(len(parts))) AS fragment_idx, unnest(parts) AS fragment FROM (
    SELECT event_id, string_split(regexp_replace(raw_line, '\\}\\s*\\{', '}' || chr(10) || '{', 'g'), chr(10)) AS parts FROM untidy))
  WHERE length(fragment) > 2)"""


def rerun_counts(sink: str) -> str:
    keys = "bronze_day, ds_day, dq_status"
    where = {"silver": "WHERE dq_status <> 'BAD'", "quarantine": "WHERE dq_status = 'BAD'", "audit": ""}[sink]
    return with_ctes(*C_BRONZE_VAL, body=f"SELECT {keys}, count(*) AS records FROM checked {where} GROUP BY {keys}")


ORACLE_SQL = {
    # gold marts
    "kpis_daily": with_ctes(*C_BASE, body=KPIS),
    "by_region": _std_by("merchant_country, merchant_city", "merchant_country, merchant_city"),
    "by_channel": _std_by("channel_g AS channel", "channel_g"),
    "by_merchant": _std_by("merchant_id_norm", "merchant_id_norm"),
    "top_merchants": with_ctes(*C_BASE, body=f"""SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY ds_day
  ORDER BY events_declined DESC, events_total DESC, merchant_id_norm ASC NULLS FIRST) AS INTEGER) AS rank
  FROM (SELECT ds_day, merchant_id_norm, {STD} FROM gbase GROUP BY ds_day, merchant_id_norm)) WHERE rank <= 20"""),
    "hourly": _std_by("event_hour, day_of_week", "event_hour, day_of_week"),
    "by_decline_reason": with_ctes(*C_BASE, body=f"""SELECT ds_day, decline_reason_g AS decline_reason, count(*) AS events_total,
  CAST(sum(is_declined) AS BIGINT) AS events_declined, {r6('sum(is_declined) / count(*)')} AS decline_rate
  FROM gbase GROUP BY ds_day, decline_reason_g"""),
    "by_payment_method": _std_by("coalesce(payment_method, 'UNKNOWN') AS payment_method", "coalesce(payment_method, 'UNKNOWN')"),
    "gold_events_daily": with_ctes(*C_BASE, body=WIDE),
    "kpis_by_event_date": with_ctes(*C_BASE, body=f"""SELECT ds_day AS event_date, count(*) AS total_transacoes,
  CAST(sum(is_approved) AS BIGINT) AS total_aprovadas, CAST(sum(is_declined) AS BIGINT) AS total_negadas,
  {r6('avg(risk_score_num)')} AS media_risk_score FROM gbase GROUP BY ds_day"""),
    "v_daily_by_type": with_ctes(*C_BASE, body=f"""SELECT ds_day, coalesce(event_type, 'UNKNOWN') AS event_type,
  count(*) AS total_transactions, {r6('sum(amount_num)')} AS total_amount FROM gbase GROUP BY ds_day, coalesce(event_type, 'UNKNOWN')"""),
    "events_count": with_ctes(*C_SILVER, body="SELECT count(*) AS events_total FROM silver"),
    "status_normalize": with_ctes(*C_BASE, body="""SELECT transaction_id, approved_norm, is_approved, is_declined,
  CASE WHEN approved_norm = 1 THEN 'APPROVED' WHEN approved_norm = 0 THEN 'DECLINED' ELSE 'UNKNOWN' END AS status FROM gbase"""),
    "safe_col_coalesce": with_ctes(*C_PAY, body=f"""SELECT transaction_id, approved_norm,
  CASE WHEN approved_norm = 1 THEN 'APPROVED' WHEN approved_norm = 0 THEN 'DECLINED' ELSE 'UNKNOWN' END AS status,
  {r6('amount')} AS amount_num, {r6('risk_score')} AS risk_score_num, {truthy01('is_international')} AS is_international_num,
  coalesce(channel, 'UNKNOWN') AS channel, coalesce(decline_reason, 'UNKNOWN') AS decline_reason,
  coalesce({_mj('merchant_id')}, merchant_id) AS merchant_id_norm, {_mj('mcc')} AS merchant_mcc,
  {_mj('country')} AS merchant_country, {_mj('city')} AS merchant_city
FROM (SELECT *, coalesce({boolish('approved')}, CASE WHEN upper(trim(status)) = 'APPROVED' THEN 1
  WHEN upper(trim(status)) = 'DECLINED' THEN 0 END) AS approved_norm FROM payments)"""),
    "partition_columns": with_ctes(*C_SILVER, body="""SELECT CAST(year(ds_day) AS INTEGER) AS event_year,
  lpad(CAST(month(ds_day) AS VARCHAR), 2, '0') AS event_month, lpad(CAST(day(ds_day) AS VARCHAR), 2, '0') AS event_day,
  count(*) AS events FROM silver GROUP BY 1, 2, 3"""),
    "risk_buckets": with_ctes(*C_SILVER, body=f"SELECT ds_day, {RISK_BUCKET} AS risk_bucket, count(*) AS events FROM silver GROUP BY 1, 2"),
    "dedup_event_id": with_ctes(*C_SILVER, DEDUP_SILVER, body="SELECT event_id, transaction_id FROM dsilver"),
    # column functions
    "parse_event_ts": with_ctes(UNTIDY, body=f"SELECT event_id, time_text, {parse_ts('time_text')} AS event_ts FROM untidy"),
    "drop_null_event_ts": with_ctes(UNTIDY, body=f"""SELECT * FROM (SELECT event_id, {parse_ts('time_text')} AS event_ts
  FROM untidy) WHERE event_ts IS NOT NULL"""),
    "ingest_ts": with_ctes(UNTIDY, body=f"""SELECT event_id, 'ingest_time' AS variant, {parse_ts('time_text')} AS ingest_ts FROM untidy
  UNION ALL SELECT event_id, 'ingest_timestamp' AS variant, ts AS ingest_ts FROM events"""),
    "event_ts_fallback": with_ctes(UNTIDY, body=f"""SELECT u.event_id, coalesce({parse_ts('u.time_text')},
  {parse_ts("CASE WHEN e.event_id % 2 = 0 THEN strftime(e.ts, '%Y-%m-%d %H:%M:%S') END")}, e.ts) AS event_ts
  FROM untidy u JOIN events e ON u.event_id = e.event_id"""),
    "clean_amount": with_ctes(UNTIDY, body=f"""SELECT event_id, amount_text, {r6(clean_amount('amount_text'))} AS amount,
  {r6(clean_amount('amount_text', strict=True))} AS amount_strict FROM untidy"""),
    "country_iso2": with_ctes(UNTIDY, body=f"""SELECT event_id, coalesce({iso2('country_a')}, {iso2('country_b')}) AS country_iso2,
  {iso2('coalesce(country_a, country_b)')} AS country_iso2_strict FROM untidy"""),
    "country_name": with_ctes(UNTIDY, body=f"""SELECT event_id, iso AS country_iso2, {country_name('iso')} AS country_name
  FROM (SELECT event_id, coalesce({iso2('country_a')}, {iso2('country_b')}) AS iso FROM untidy)"""),
    "normalize_codes": with_ctes(*C_PAY, body="""SELECT transaction_id, upper(trim(currency)) AS currency,
  CASE WHEN upper(trim(country)) = 'UK' THEN 'GB' ELSE upper(trim(country)) END AS country,
  CASE WHEN upper(trim(channel)) = 'MOBILE_APP' THEN 'MOBILE' ELSE upper(trim(channel)) END AS channel,
  upper(trim(status)) AS status, upper(trim(country)) AS country_strict, upper(trim(channel)) AS channel_strict FROM payments"""),
    "boolish_to_int": with_ctes(UNTIDY, body=f"SELECT event_id, bool_text, {boolish('bool_text')} AS flag FROM untidy"),
    "is_international": with_ctes(UNTIDY, body=f"SELECT event_id, bool_text, {truthy01('bool_text')} AS is_international FROM untidy"),
    "merchant_parse": with_ctes(UNTIDY, body=f"""SELECT event_id, {_mj('city')} AS city, {_mj('country')} AS country,
  {_mj('mcc')} AS mcc, {_mj('merchant_id')} AS merchant_id FROM untidy"""),
    "country_surrogate": with_ctes(*C_SILVER, body=f"""SELECT ds, {SURROGATE} AS country_iso2, {r6('amount_double')} AS amount_double,
  {r6('risk_score')} AS risk_score, approved_int, is_international_int FROM silver"""),
    # quality
    "dq_errors": with_ctes(*C_VAL, body="""SELECT transaction_id, dq_error FROM (SELECT transaction_id,
  unnest(string_split(dq_errors, ',')) AS dq_error FROM checked WHERE dq_errors <> '')"""),
    "dq_status": with_ctes(*C_VAL, body="SELECT transaction_id, dq_status, dq_errors, dq_hard_errors FROM checked"),
    "dq_good_rows": with_ctes(*C_SILVER, body=f"""SELECT transaction_id, event_id, ds_day, dq_status, dq_errors, currency, country,
  channel, status, {r6('amount')} AS amount, approved_int, is_international_int, country_iso2, {RISK_BUCKET} AS risk_bucket FROM silver"""),
    "dq_quarantine": with_ctes(*C_VAL, body="""SELECT transaction_id, event_id, user_id, dq_status, dq_errors, dq_hard_errors, ds_day
  FROM checked WHERE dq_status = 'BAD'"""),
    "dq_audit": _counts_by("ds_day, dq_status", "checked", C_VAL),
    "dq_error_counts": with_ctes(*C_VAL, body="""SELECT ds_day, dq_error, count(*) AS records FROM (SELECT ds_day,
  unnest(string_split(dq_errors, ',')) AS dq_error FROM checked WHERE dq_errors <> '') GROUP BY ds_day, dq_error"""),
    "pipeline_counters": with_ctes(*C_VAL, body="""SELECT count(*) AS rows_total, count(*) FILTER (WHERE dq_status = 'GOOD') AS rows_good,
  count(*) FILTER (WHERE dq_status = 'WARN') AS rows_warn, count(*) FILTER (WHERE dq_status = 'BAD') AS rows_bad FROM checked"""),
    # bronze
    "bronze_unglue": with_ctes(UNTIDY, BRONZE_FRAGMENTS, body="SELECT event_id, fragment_idx, fragment FROM fragments"),
    "infer_event_schema": with_ctes(UNTIDY, BRONZE_FRAGMENTS, body="""SELECT field, replace(replace(replace(replace(replace(
    replace(type, '{"', 'struct<'), '"}', '>'), '":"', ':'), '"', ''), 'UBIGINT', 'bigint'), 'VARCHAR', 'string') AS type FROM (
    SELECT field, CAST(json_extract(st, '$.' || field) AS VARCHAR) AS type FROM (
      SELECT st, unnest(json_keys(st)) AS field FROM (SELECT json_group_structure(CAST(fragment AS JSON)) AS st FROM fragments)))"""),
    "bronze_parse_typed": with_ctes(*C_BRONZE, body=f"""SELECT transaction_id, event_id, user_id, card_id, merchant_id, merchant,
  {r6('amount')} AS amount, currency, payment_method, channel, country, device_ip AS ip_address, {r6('risk_score')} AS risk_score,
  is_international, status, approved, decline_reason, event_type, event_ts, event_time, mcc, device, metadata,
  CASE WHEN src_id % 5 = 1 THEN other_country END AS country_code, CASE WHEN src_id % 5 = 2 THEN other_country END AS "countryCode",
  CASE WHEN src_id % 5 = 3 THEN other_country END AS country_iso, CASE WHEN src_id % 5 = 4 THEN other_country END AS country_iso2,
  is_malformed AS is_malformed_json FROM parsed"""),
    "bronze_scan_day": f"""SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
  count(*) AS lines FROM {ARRIVED} WHERE d = {BRONZE_DAY} GROUP BY d""",
    "bronze_scan_lineage": f"""SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
  count(*) AS lines, count(*) AS lines_with_source FROM {ARRIVED} GROUP BY d""",
    # tables and sinks
    "silver_scan_day": with_ctes(*C_SILVER, body=f"""SELECT transaction_id, event_id, {r6('amount')} AS amount, channel, ds_day
  FROM silver WHERE ds_day = (SELECT max(ds_day) FROM silver)"""),
    "silver_scan_paths": with_ctes(*C_SILVER, body=f"SELECT ds_day, count(*) AS events, {r6('sum(amount)')} AS amount_sum FROM silver GROUP BY ds_day"),
    "external_table_scan": with_ctes(*C_SILVER, body=f"""SELECT ds_day, channel, count(*) AS events, {r6('sum(amount)')} AS amount_sum
  FROM silver GROUP BY ds_day, channel"""),
    "latest_partition_day": with_ctes(*C_SILVER, body="SELECT max(ds_day) AS latest_day FROM silver"),
    "table_append_readback": _counts_by("ds_day, dq_status", "silver", C_SILVER),
    "silver_write_readback": SILVER_READBACK,
    "silver_unknown_fields": SILVER_UNKNOWN_FIELDS,
    "gold_write_readback": KPIS_BRONZE,
    "gold_rerun_idempotent": KPIS_BRONZE,
    "gold_days_separately": KPIS_BRONZE,
    "gold_rerun_corrected": KPIS_BRONZE,
    "gold_rerun_removed_copy": KPIS_BRONZE,
    "gold_rerun_after_crash": KPIS_BRONZE,
    "silver_rerun_corrected": rerun_counts("silver"),
    "quarantine_rerun_corrected": rerun_counts("quarantine"),
    "audit_rerun_corrected": rerun_counts("audit"),
    "external_table_unpartitioned": with_ctes(*C_BASE, body=KPIS),
    "external_table_single_file": with_ctes(*C_BASE, body=KPIS),
    "kpi_snapshot_ctas": with_ctes(*C_BASE, f"wide AS ({WIDE_RAW})", body=WIDE_PCT_BODY),
    # geo
    "geoip_range_join": with_ctes(*C_GEO, body=f"""SELECT transaction_id, device_ip, geo_iso2 AS country_iso2, country_name,
  {r6('latitude')} AS latitude, {r6('longitude')} AS longitude FROM enriched"""),
    "geo_daily": with_ctes(*C_GEO, body=geo_daily_sql(False)),
    "geo_daily_keep_unknown": with_ctes(*C_GEO, body=geo_daily_sql(True)),
    "v_geo_daily": with_ctes(*C_GEO_MART, body=f"""SELECT ds, country_iso2, CAST(sum(events_total) AS BIGINT) AS events_total,
  {r6('sum(amount_sum)')} AS amount_sum, {r6('avg(risk_score_avg)')} AS risk_score_avg,
  CAST(sum(international_total) AS BIGINT) AS international_total
  FROM geo WHERE ds >= {SINCE} AND country_iso2 IS NOT NULL GROUP BY 1, 2"""),
    "v_geo_daily_weighted": with_ctes(*C_GEO_MART, body=f"""SELECT ds, country_iso2, CAST(sum(events_total) AS BIGINT) AS events_total,
  {r6('sum(amount_sum)')} AS amount_sum,
  {r6('sum(risk_score_avg * events_total) / sum(CASE WHEN risk_score_avg IS NOT NULL THEN events_total END)')} AS risk_score_avg,
  CAST(sum(international_total) AS BIGINT) AS international_total
  FROM geo WHERE ds >= {SINCE} AND country_iso2 IS NOT NULL GROUP BY 1, 2"""),
    "v_geo_dashboard_latlon": with_ctes(*C_GEO_MART, DIM, body=f"""SELECT g.ds, g.country_iso2, g.country_name, g.events_total,
  g.transactions_total, g.approved_total, g.declined_total, {r6('g.amount_sum')} AS amount_sum,
  {r6('g.risk_score_avg')} AS risk_score_avg, g.international_total, {r6('d.lat')} AS lat, {r6('d.lon')} AS lon
  FROM geo g LEFT JOIN dim d ON g.country_iso2 = d.country_iso2
  WHERE g.ds >= {SINCE} AND g.country_iso2 <> '{K.UNKNOWN_ISO2}'"""),
    "latest_geo_rows": with_ctes(*C_GEO, body=geo_daily_sql(True) + " ORDER BY ds DESC, country_iso2 ASC LIMIT 10"),
    "v_geo_passthrough": with_ctes(*C_GEO, body=geo_daily_sql(True)),
    "v_gold_passthrough": with_ctes(*C_BASE, body=WIDE),
    "v_kpis_daily": with_ctes(*C_BASE, f"wide AS ({WIDE_RAW})", body=WIDE_PCT_BODY),
    "v_dashboard": with_ctes(*C_BASE, f"wide AS ({WIDE_RAW})", body=f"""SELECT ds_day, events_total, transactions_total,
  approved_total, declined_total, {r6('amount_sum')} AS amount_sum, {r6('amount_avg')} AS amount_avg,
  {r6('risk_score_avg')} AS risk_score_avg, international_total,
  {r6('CAST(approved_total AS DOUBLE) / nullif(transactions_total, 0)')} AS approval_rate,
  {r6('CAST(declined_total AS DOUBLE) / nullif(transactions_total, 0)')} AS decline_rate FROM wide"""),
    # streaming
    "stream_land_bronze": with_ctes(*C_PAY, body=f"""SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  CAST(day(d) AS INTEGER) AS day, count(*) AS lines FROM (SELECT CASE WHEN src_id % 83 = 0 AND src_id % 166 <> 0
    OR src_id % 89 = 0 AND src_id % 10 <> 0 THEN {AS_OF_DATE} ELSE ds END AS d
  FROM payments) GROUP BY d"""),
    "stream_validate": with_ctes(*C_BRONZE_VAL, body="""SELECT CASE WHEN dq_status = 'BAD' THEN 'quarantine' ELSE 'silver' END AS sink,
  ds_day, dq_status, count(*) AS records FROM checked GROUP BY 1, 2, 3"""),
    "stream_audit": _counts_by("ds_day, dq_status", "checked", C_BRONZE_VAL),
    "stream_dedup": with_ctes(*C_PAY, body="""SELECT DISTINCT event_id FROM payments WHERE event_id IS NOT NULL
  UNION ALL SELECT event_id FROM payments WHERE event_id IS NULL"""),
}
# the views by name give what the DataFrame functions give
for _name, _view in (("v_geo_daily_by_name", "v_geo_daily"), ("v_geo_dashboard_by_name", "v_geo_dashboard_latlon"),
                     ("v_kpis_by_name", "v_kpis_daily"), ("v_dashboard_by_name", "v_dashboard")):
    ORACLE_SQL[_name] = ORACLE_SQL[_view]
ORACLE_SQL["cards_by_period"] = with_ctes(*C_BASE, body="""SELECT period, CASE period WHEN 'day' THEN ds_day
  ELSE CAST(date_trunc(period, ds_day) AS DATE) END AS period_start, count(DISTINCT card_id) AS distinct_cards
  FROM gbase, (VALUES ('day'), ('week'), ('month')) p(period) GROUP BY 1, 2""")
ORACLE_SQL["silver_incremental_landing"] = rerun_counts("silver").replace(
    "count(*) AS records", "count(*) AS records, 0 AS days_run_again")
ORACLE_SQL["bronze_sample_profile"] = with_ctes(UNTIDY, """sampled AS (SELECT * FROM (
  SELECT CAST(e.ts AS DATE) AS day, u.event_id, u.raw_line, row_number() OVER (PARTITION BY CAST(e.ts AS DATE)
    ORDER BY md5(u.raw_line), u.raw_line) AS place FROM untidy u JOIN events e ON u.event_id = e.event_id) WHERE place <= 20)""",
    BRONZE_FRAGMENTS.replace("FROM untidy", "FROM sampled").replace("event_id", "day"),
    body="""SELECT day, field, count(*) AS objects,
  count(json_extract_string(CAST(fragment AS JSON), '$.' || field)) AS filled
  FROM (SELECT day, fragment, unnest(json_keys(CAST(fragment AS JSON))) AS field FROM fragments) GROUP BY day, field""")
ORACLE_SQL["schema_registry"] = with_ctes(UNTIDY.replace("raw_line", "line"), """dayed AS (SELECT event_id, event_id % 3 AS k,
  CASE event_id % 3 WHEN 1 THEN regexp_replace(line, '"amount":([0-9]+)', '"amount":\\1.5', 'g')
    WHEN 2 THEN regexp_replace(line, '\\}$', ',"channel":"web"}') ELSE line END AS raw_line FROM untidy)""",
    BRONZE_FRAGMENTS.replace("FROM untidy", "FROM dayed"),
    body="""SELECT version, field, replace(replace(replace(replace(replace(replace(
    replace(type, '{"', 'struct<'), '"}', '>'), '":"', ':'), '"', ''), 'UBIGINT', 'bigint'), 'VARCHAR', 'string'), 'DOUBLE', 'double') AS type
  FROM (SELECT version, field, CAST(json_extract(st, '$.' || field) AS VARCHAR) AS type FROM (
    SELECT version, st, unnest(json_keys(st)) AS field FROM (
      SELECT CAST(version AS INTEGER) AS version, json_group_structure(CAST(fragment AS JSON)) AS st
      FROM fragments, (VALUES (1), (2), (3)) v(version) WHERE event_id % 3 < version GROUP BY version)))""")
ORACLE_SQL["stream_dedup_batched"] = ORACLE_SQL["stream_dedup"]
