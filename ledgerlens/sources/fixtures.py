"""Payment events derived deterministically from the driver's ``events`` table.

The driver tables carry no payment fields, so these adapters derive them with
column arithmetic on ``event_id``/``user_id`` and plant the defects the
operators must handle (null and duplicate ids, negative and null amounts,
unknown country, risk above 1, padded or unknown channels, null approvals).
They are map-only projections: the work grows with ``events`` and nothing is
shuffled.  ``FIXTURES.md`` holds the equivalent SQL used by the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _s(c: Column) -> Column:
    return c.cast("string")


def _case(key: Column, values: list[str]) -> Column:
    """values[key] for key in 0..len-1 (a CASE over a small modulus)."""
    out = F.when(key == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        out = out.when(key == i, F.lit(v))
    return out


def merchant_text(i: Column) -> Column:
    """Merchant blob in three shapes: JSON object, bare id, partial JSON, NULL."""
    city = _case(i % 3, ["Sao Paulo", "Miami", "London"])
    ctry = _case(i % 3, ["BR", "US", "GB"])
    obj = F.concat(F.lit('{"city":"'), city, F.lit('","country":"'), ctry, F.lit('","mcc":"'),
                   _s(F.lit(5000) + i % 9), F.lit('","merchant_id":"m_'), _s(i % 50), F.lit('"}'))
    return (F.when(i % 4 == 0, obj)
            .when(i % 4 == 1, F.concat(F.lit("m_"), _s(i % 50)))
            .when(i % 4 == 2, F.lit('{"city":"Recife"}'))
            .when(i % 28 == 3, F.lit("shop }{ annex")))


def _merchant_sql(i: str = "event_id") -> str:
    return (f"CASE {i} % 4 WHEN 0 THEN concat('{{\"city\":\"', CASE {i} % 3 WHEN 0 THEN 'Sao Paulo' WHEN 1 THEN 'Miami' "
            f"ELSE 'London' END, '\",\"country\":\"', CASE {i} % 3 WHEN 0 THEN 'BR' WHEN 1 THEN 'US' ELSE 'GB' END, "
            f"'\",\"mcc\":\"', CAST(5000 + {i} % 9 AS STRING), '\",\"merchant_id\":\"m_', CAST({i} % 50 AS STRING), "
            f"'\"}}') WHEN 1 THEN concat('m_', CAST({i} % 50 AS STRING)) WHEN 2 THEN '{{\"city\":\"Recife\"}}' "
            f"ELSE CASE WHEN {i} % 28 = 3 THEN 'shop }}{{ annex' END END")


# One SQL expression per column (FIXTURES.md section 7): a single projection,
# built with one call per column.
PAYMENT_COLUMNS = [
    "CASE WHEN event_id % 211 = 0 THEN NULL ELSE concat('evt_', CAST(event_id - CASE WHEN event_id % 97 = 1 THEN 1 WHEN event_id % 101 = 7 AND event_id >= 700 THEN 700 ELSE 0 END AS STRING)) END AS event_id",
    "concat('txn_', CAST(event_id AS STRING)) AS transaction_id",
    "concat('user_', CAST(user_id AS STRING)) AS user_id",
    "concat('card_', CAST(user_id % 61 AS STRING)) AS card_id",
    "concat('m_', CAST(event_id % 50 AS STRING)) AS merchant_id",
    "CASE WHEN event_id % 173 = 0 THEN -value WHEN event_id % 179 = 0 THEN NULL WHEN event_id % 223 = 0 THEN CAST(10000000 + event_id AS DOUBLE) WHEN event_id % 227 = 0 THEN CAST(1 + event_id % 9 AS DOUBLE) / 10000 ELSE value END AS amount",
    "CASE event_id % 4 WHEN 0 THEN 'BRL' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' ELSE 'ARS' END AS currency",
    "CASE event_id % 6 WHEN 0 THEN 'CREDIT_CARD' WHEN 1 THEN 'DEBIT_CARD' WHEN 2 THEN 'PIX' WHEN 3 THEN 'BOLETO' WHEN 4 THEN 'APPLE_PAY' ELSE 'GOOGLE_PAY' END AS payment_method",
    "CASE event_type WHEN 'view' THEN 'web' WHEN 'click' THEN ' MOBILE ' WHEN 'purchase' THEN 'POS' WHEN 'signup' THEN 'ECOMMERCE' ELSE 'MOBILE_APP' END AS channel",
    "CASE WHEN event_id % 191 = 0 THEN 'XX' ELSE CASE event_id % 4 WHEN 0 THEN 'BR' WHEN 1 THEN 'US' WHEN 2 THEN 'UK' ELSE 'AR' END END AS country",
    "CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 43 = 0 THEN 'unknown' WHEN event_id % 7 = 3 THEN concat('2001:DB8:', CAST(event_id % 5 AS STRING), '::', CAST(user_id % 10 AS STRING)) WHEN event_id % 7 = 5 THEN concat('2a05:', CAST(user_id % 10 AS STRING), '::1.2.3.4') ELSE concat(CASE WHEN event_id % 7 = 6 THEN '::ffff:' ELSE '' END, CAST(1 + user_id % 223 AS STRING), '.', CAST(event_id % 256 AS STRING), '.0.', CAST(user_id % 256 AS STRING)) END AS device_ip",
    "CASE WHEN event_id % 199 = 0 THEN CAST(1.5 AS DOUBLE) ELSE CAST(event_id % 101 AS DOUBLE) / 100 END AS risk_score",
    "CASE WHEN event_id % 4 = 0 THEN 0 ELSE 1 END AS is_international",
    "CASE WHEN event_id % 101 > 75 THEN 'DECLINED' ELSE 'APPROVED' END AS status",
    "CASE WHEN event_id % 101 > 75 THEN 'false' WHEN event_id % 13 = 0 THEN NULL ELSE 'yes' END AS approved",
    "CASE WHEN event_id % 101 > 75 THEN CASE event_id % 3 WHEN 0 THEN 'INSUFFICIENT_FUNDS' WHEN 1 THEN 'SUSPECTED_FRAUD' ELSE 'LIMIT' END END AS decline_reason",
    "event_type",
    "ts AS event_ts",
    "CAST(ts AS DATE) AS ds",
    _merchant_sql() + " AS merchant",
]


def payment_events(events: DataFrame, keep_source_id: bool = False) -> DataFrame:
    """One payment event per driver event (FIXTURES.md section 7 plus ``merchant``)."""
    cols = PAYMENT_COLUMNS + (["event_id AS src_id"] if keep_source_id else [])
    return events.selectExpr(*cols)


def untidy_text(events: DataFrame, keep: tuple = ()) -> DataFrame:
    """Text in every form the parsers accept (FIXTURES.md section 8);
    ``keep`` names source columns to carry along."""
    i = F.col("event_id")

    def pad2(c: Column) -> Column:
        return F.lpad(_s(c), 2, "0")

    epoch = F.lit(1704067200) + i * 60
    time_text = (F.when(i % 5 == 0, _s(epoch))
                 .when(i % 5 == 1, F.concat(_s(epoch), F.lit("123")))
                 .when(i % 5 == 2, F.concat(pad2(1 + i % 28), F.lit("/01/2024 "), pad2(i % 24), F.lit(":"), pad2(i % 60), F.lit(":07")))
                 .when(i % 5 == 3, F.concat(F.lit("2024-01-"), pad2(1 + i % 28), F.lit("T"), pad2(i % 24), F.lit(":"), pad2(i % 60), F.lit(":07Z")))
                 .otherwise(F.lit("nope")))
    amount_text = (F.when(i % 5 == 0, F.concat(F.lit("R$ 1."), F.lpad(_s(i % 1000), 3, "0"), F.lit(","), pad2(i % 100)))
                   .when(i % 5 == 1, F.concat(_s(i % 1000), F.lit(","), pad2(i % 100)))
                   .when(i % 5 == 2, F.concat(F.lit("  "), _s(i % 1000), F.lit("."), pad2(i % 100), F.lit(" ")))
                   .when(i % 5 == 3, F.concat(F.lit("-"), _s(i % 1000)))
                   .otherwise(F.lit("abc")))
    country_a = _case(i % 7, [" br ", "N/A", "", "BRAZIL", "us", "unk"])
    country_b = F.when(i % 2 == 0, F.lit("ar")).otherwise(F.lit("GB "))
    bool_text = _case(i % 8, ["TRUE", " no ", "1", "0", "f", "Y", "maybe"])
    base = F.concat(F.lit('{"event_id":"evt_'), _s(i), F.lit('","amount":'), _s(i % 1000), F.lit(',"nested":{"k":1}}'))
    glue = (F.when(i % 10 == 0, F.concat(F.lit(' {"event_id":"glued_'), _s(i), F.lit('","amount":1}')))
            .when(i % 10 == 1, F.concat(F.lit('{"event_id":"glued_'), _s(i), F.lit('"}')))
            .otherwise(F.lit("")))
    return events.select(
        i.alias("event_id"), time_text.alias("time_text"), amount_text.alias("amount_text"),
        country_a.alias("country_a"), country_b.alias("country_b"), bool_text.alias("bool_text"),
        merchant_text(i).alias("merchant"), F.concat(base, glue).alias("raw_line"), *keep)


# ISO text of the event time as the event producer writes it
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


COUNTRY_FIELDS = ["country", "country_code", "countryCode", "country_iso", "country_iso2"]


def with_undeclared_fields(lines: DataFrame) -> DataFrame:
    """Raw lines whose records carry two fields that the event schema does not
    declare: an object with the transaction's number, and a text made of it."""
    extra = r'$0, "loyalty":{"points":$1,"tier":"t }{ $1"},"coupon":"c$1"'
    return lines.withColumn("value", F.regexp_replace("value", r'"transaction_id"\s*:\s*"txn_([0-9]+)"', extra))


def bronze_lines(events: DataFrame) -> DataFrame:
    """Raw bronze lines (one JSON object per payment event, producer field
    names) with planted defects, plus the partition columns of the day it
    arrived: a day late for ``i % 31 == 0``.

    By source id ``i``: the country is in one of five fields (``i % 5``);
    ``i % 3 == 1`` writes blanks after colons and commas; an amount of ten
    million or more is a plain number for even ``i``, else scientific;
    ``i % 10 == 0`` the object is glued to a copy of itself (with a blank when
    ``i % 20 == 0``); ``i % 89 == 0`` (and not glued) the closing brace is
    lost; ``i % 83 == 0`` the time is not a time, and for even ``i`` a second
    time field holds it; ``i % 71 == 0`` (and none of the above) the amount is
    text with a decimal comma; ``i % 53 == 0`` (and none of the above) an empty
    object ``{}`` trails the line.
    """
    p = payment_events(events, keep_source_id=True)
    i = F.col("src_id")
    good_time = F.date_format("event_ts", ISO_SECONDS)
    obj = F.to_json(F.struct(
        "event_id", "transaction_id", "user_id", "card_id", "merchant_id", "merchant",
        "amount", "currency", "payment_method", "channel",
        *[F.when(i % 5 == k, F.col("country")).alias(name) for k, name in enumerate(COUNTRY_FIELDS)],
        F.col("device_ip").alias("ip_address"), "risk_score", "is_international", "status",
        "approved", "decline_reason", "event_type",
        F.when(i % 6 == 1, F.lit(4000) + i % 7).alias("mcc"),
        F.struct((i % 3).alias("model")).alias("device"),
        F.when(i % 2 == 0, F.struct(F.lit(1).alias("k"), F.concat(F.lit("a}{"), _s(i % 4)).alias("v"))).alias("metadata"),
        F.when(i % 83 == 0, F.lit("not-a-time")).otherwise(good_time).alias("event_ts"),
        F.when(i % 166 == 0, good_time).alias("event_time"),
    ))
    o = F.col("o")
    plain = F.regexp_replace(o, r'"amount":[0-9.]+E7', F.concat(
        F.lit('"amount":'), F.coalesce(F.col("amount").cast("decimal(20,2)").cast("string"), F.lit("0"))))
    # few amounts are that large: the others' lines are not searched
    plain = F.when(o.contains("E7"), plain).otherwise(o)
    spaced = F.regexp_replace(F.regexp_replace(o, r'([^\\\\])":', '$1": '), ',"', ', "')
    comma_amount = F.regexp_replace(o, r'"amount":( ?)(-?[0-9]+)\.([0-9]+)([,}])', '"amount":$1"$2,$3"$4')
    line = (F.when(i % 20 == 0, F.concat(o, F.lit(" "), o))
            .when(i % 10 == 0, F.concat(o, o))
            .when(i % 89 == 0, F.expr("substring(o, 1, length(o) - 1)"))
            .when(i % 71 == 0, comma_amount)
            .when(i % 53 == 0, F.concat(o, F.lit("{}")))
            .otherwise(o))
    arrived = F.date_add("ds", F.when(i % 31 == 0, 1).otherwise(0))
    return (p.withColumn("o", obj).withColumn("o", F.when(i % 2 == 0, plain).otherwise(o))
             .withColumn("o", F.when(i % 3 == 1, spaced).otherwise(o))
             .select(line.alias("value"), *[F.date_format(arrived, part).alias(name)
                                            for name, part in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))]))


def faulty_lines(lines: DataFrame, first_day) -> DataFrame:
    """``lines`` before their correction: of those that arrived on ``first_day``
    or the next day, some have another event day and some a broken status; and
    copies of the first day's lines lie under the day before it."""
    day = F.make_date(*[F.col(c).cast("int") for c in ("year", "month", "day")])
    first = F.lit(str(first_day)).cast("date")
    early = day <= F.date_add(first, 1)
    kind = F.pmod(F.crc32("value"), F.lit(5))
    moved = F.regexp_replace("value", r'("event_ts": ?"20[0-9]{2}-[0-9]{2})-[0-9]{2}T', "$1-15T")
    broken = F.regexp_replace("value", r'"status": ?"[A-Z]+"', '"status":"LOST"')
    value = F.when(early & (kind == 0), moved).when(early & (kind == 1), broken).otherwise(F.col("value"))
    before = F.date_sub(first, 1)
    stray = lines.where(day == first).select("value", *[F.date_format(before, part).alias(name) for name, part in
                                                        (("year", "yyyy"), ("month", "MM"), ("day", "dd"))])
    return lines.withColumn("value", value).select("value", "year", "month", "day").unionByName(stray)


def copied_lines(lines: DataFrame, first_day) -> DataFrame:
    """``lines`` before their correction: with later copies of those that arrived
    on ``first_day`` for that day, which arrived the next day with the next day's
    event time."""
    day = F.make_date(*[F.col(c).cast("int") for c in ("year", "month", "day")])
    first = F.lit(str(first_day)).cast("date")
    stamp = F.concat(F.lit('("event_ts": ?")'), first.cast("string"), F.lit("T"))
    later = F.concat(F.lit("$1"), F.date_add(first, 1).cast("string"), F.lit("T"))
    copies = lines.where((day == first) & F.col("value").rlike(f'"event_ts": ?"{first_day}T')).select(
        F.regexp_replace("value", stamp, later).alias("value"),
        *[F.date_format(F.date_add(first, 1), part).alias(name) for name, part in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))])
    return lines.select("value", "year", "month", "day").unionByName(copies)
