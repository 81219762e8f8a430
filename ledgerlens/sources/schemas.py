"""Schema registry: versions of an event schema, widened from run to run.

A run infers the schema of what it reads (``bronze.inferred_struct``) and
registers it.  The registered schema is the least one that holds every schema
registered before: new fields are added, none is dropped, and types meet in a
lattice (whole numbers below doubles, doubles and everything else below text;
structs field by field, arrays by their elements).  A version is written only
when something changed, as one small file that is created and never replaced.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sinks.manifest import create_file, file_numbers, read_file

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONS = (T.FloatType, T.DoubleType, T.DecimalType)


def settled(dt: T.DataType) -> T.DataType:
    """A type as the registry keeps it: JSON knows whole numbers and others."""
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, settled(f.dataType)) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(settled(dt.elementType))
    if isinstance(dt, WHOLE):
        return T.LongType()
    return T.DoubleType() if isinstance(dt, FRACTIONS) else dt


def widen(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds both."""
    a, b = settled(a), settled(b)
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        there = {f.name: f.dataType for f in b.fields}
        known = {f.name for f in a.fields}
        merged = [T.StructField(f.name, widen(f.dataType, there.get(f.name, T.NullType()))) for f in a.fields]
        return T.StructType(merged + [T.StructField(f.name, settled(f.dataType)) for f in b.fields if f.name not in known])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widen(a.elementType, b.elementType))
    if {type(a), type(b)} == {T.LongType, T.DoubleType}:
        return T.DoubleType()
    return T.StringType()


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/_schemas"


def registered_schema(spark: SparkSession, root: str, version: int | None = None) -> T.StructType:
    """A version of the schema (the newest if not given); no fields if there is none."""
    numbers = file_numbers(spark, _folder(root))
    if version is None:
        version = numbers[-1] if numbers else 0
    if not version:
        return T.StructType([])
    return T.StructType.fromJson(json.loads(read_file(spark, _folder(root), version)))


def register_schema(spark: SparkSession, root: str, inferred: T.StructType) -> tuple[int, T.StructType]:
    """Merge a run's schema into the registry; its version and the result.  Two
    runs at one time: the second gets an error and is run again."""
    numbers = file_numbers(spark, _folder(root))
    version = numbers[-1] if numbers else 0
    old = registered_schema(spark, root, version)
    fields = T.StructType([f for f in inferred.fields if f.name != "_corrupt_record"])
    new = widen(old, fields)
    if new != old or not version:
        version += 1
        create_file(spark, _folder(root), version, json.dumps(new.jsonValue()))
    return version, new


def schema_history(spark: SparkSession, root: str) -> DataFrame:
    """``version``, ``field``, ``type`` of every version."""
    rows = [(v, f.name, f.dataType.simpleString()) for v in file_numbers(spark, _folder(root))
            for f in registered_schema(spark, root, v).fields]
    return spark.createDataFrame(rows, "version int, field string, type string")
