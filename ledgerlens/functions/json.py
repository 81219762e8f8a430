"""JSON helpers: splitting glued objects and parsing the merchant blob."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: fields of the merchant object ----------------------------
MERCHANT_SCHEMA = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("mcc", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
])

# the place between one object's end and the next one's beginning
BETWEEN = r"(?<=\})\s*(?=\{)"
# whether there is such a place: without lookaround, so a line costs one search for its braces
GLUED = r"\}\s*\{"
# one object from where the last one ended: string literals are taken whole, and
# a closing brace ends it where an opening one follows or the line ends.  Each
# character is looked at once, so a line of any length costs its length; a run of
# ordinary characters is one step.
ONE_OBJECT = (r"""(?s)\G(?=.)([^"}]*(?:(?:"[^"\\]*(?:\\.[^"\\]*)*+"|\}(?!\s*+\{))[^"}]*)*+"""
              r"""(?:\}(?=\s*+\{)|\z))\s*+""")
# a line that is one object for all its braces: its literals close, no backslash
# stands outside of them, and what looks like such a place is inside
ONE_LINE = r"""(?s)\A[^"}\\]*+(?:(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"|\}(?!\s*+\{))[^"}\\]*+)*+\z"""
# a line in which the quotes that no backslash escapes come in pairs, looked at once;
# a pair of backslashes escapes nothing
_UNQUOTED = r"""[^"\\]*+(?:\\.[^"\\]*+)*+"""
LITERALS_CLOSE = rf"""(?s)\A(?:{_UNQUOTED}"{_UNQUOTED}")*+{_UNQUOTED}\\?\z"""


def unglue_fragments(c: Column) -> Column:
    """Array of the JSON objects of a line that holds several, with or without
    blanks between them; braces inside string literals do not count.

    Explode the result (``posexplode`` keeps the fragment index for lineage).
    In a line whose string literals do not close, braces are the only hint:
    it is cut at each ``}{``, so that its whole objects are kept and the broken
    one is quarantined.
    """
    return (F.when(~c.rlike(GLUED) | c.rlike(ONE_LINE), F.array(c))
            .when(c.rlike(LITERALS_CLOSE), F.regexp_extract_all(c, F.lit(ONE_OBJECT), F.lit(1)))
            .otherwise(F.split(c, BETWEEN)))


def merchant_struct(df: DataFrame, name: str = "merchant") -> Column:
    """Merchant struct(city, country, mcc, merchant_id).

    A struct column is used as is; text is parsed only when it starts with
    ``{``; anything else (or a missing column) gives a NULL struct.
    """
    if name not in df.columns:
        return F.lit(None).cast(MERCHANT_SCHEMA)
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StructType):
        fields = {f.name for f in dtype.fields}
        return F.struct(*[
            (F.col(f"{name}.{f.name}").cast("string") if f.name in fields else F.lit(None).cast("string")).alias(f.name)
            for f in MERCHANT_SCHEMA.fields
        ])
    s = F.col(name).cast("string")
    return F.when(s.startswith("{"), F.from_json(s, MERCHANT_SCHEMA)).otherwise(F.lit(None).cast(MERCHANT_SCHEMA))
