"""Internet addresses as ordered keys (for range joins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DOTTED_QUAD = r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"
HEX_GROUP = r"^[0-9a-f]{1,4}$"
KEY_BYTES = 16
# where IPv4 lies among the 128-bit addresses (::ffff:0:0/96)
V4_PREFIX = "0" * 20 + "ffff"


def _hex(number: Column, digits: int) -> Column:
    return F.lpad(F.lower(F.hex(number)), digits, "0")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ipv4_to_long(c: Column) -> Column:
    """Dotted IPv4 -> long; anything else (IPv6, octet > 255, junk) -> NULL."""
    def number(octets: Column) -> Column:
        return F.when(F.forall(octets, lambda o: o <= 255),
                      F.aggregate(octets, F.lit(0).cast("long"), lambda acc, o: acc * 256 + o))

    s = F.trim(c.cast("string"))
    return F.when(s.rlike(DOTTED_QUAD), _let(F.transform(F.split(s, r"\."), lambda o: o.cast("long")), number))


def _groups(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), ":"), lambda g: g != "")


def _ipv6_key(s: Column) -> Column:
    """32 hex digits of an IPv6 address in lower case, else NULL."""
    def key(parts: Column) -> Column:
        head, tail, gaps = parts["head"], parts["tail"], parts["gaps"]
        known = F.size(head) + F.size(tail)
        fits = ((gaps == 0) & (known == 8)) | ((gaps == 1) & (known <= 7))
        zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - known, F.lit(0)))
        return F.when(fits, _let(F.concat(head, zeros, tail), lambda every: F.when(
            F.forall(every, lambda g: g.rlike(HEX_GROUP)),
            F.array_join(F.transform(every, lambda g: F.lpad(g, 4, "0")), ""))))

    halves = _let(F.split(s, "::"), lambda h: F.struct(
        _groups(F.get(h, F.lit(0))).alias("head"), _groups(F.get(h, F.lit(1))).alias("tail"),
        (F.size(h) - 1).alias("gaps")))
    return F.when(s.contains(":") & ~s.rlike(r":::|^:[^:]|[^:]:$"), _let(halves, key))


def ip_key(c: Column) -> Column:
    """An address of either family as 32 hex digits whose text order is the
    order of addresses; IPv4 takes its mapped place.  No address -> NULL."""
    def v4(s: Column) -> Column:
        return F.concat(F.lit(V4_PREFIX), _hex(ipv4_to_long(s), 8))

    def mixed(s: Column) -> Column:
        # an IPv4 address at the end of an IPv6 one stands for its last two groups
        last = _hex(ipv4_to_long(F.regexp_extract(s, r"([0-9.]+)$", 1)), 8)
        return F.concat(F.regexp_extract(s, r"^(.*:)[0-9.]+$", 1), F.regexp_replace(last, "^(.{4})", "$1:"))

    def key(s: Column) -> Column:
        return (F.when(~s.contains(":"), v4(s))
                .otherwise(_let(F.when(s.contains("."), mixed(s)).otherwise(s), _ipv6_key)))

    return _let(F.lower(F.trim(c.cast("string"))), key)
