"""Parquet folders whose files changed types from delivery to delivery.

Spark merges footers that differ in columns but raises on one column with two types.
Here each folder's schema is read once (one footer), folders of equal schemas are one
scan, and every column is widened to the narrowest type that holds all its versions
before the scans are united; a column that a folder lacks is NULL there.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_WHOLE_DIGITS = [3, 5, 10, 19]
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
FOOTERS_AT_ONCE = 8
#: Values of integer columns that elsewhere are timestamps: units since 1970.
EPOCH_UNITS = {"seconds": 1_000_000, "millis": 1_000, "micros": 1}


def _whole(t: T.DataType) -> int | None:
    return next((i for i, w in enumerate(_WHOLE) if isinstance(t, type(w))), None)


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds both.

    Integers widen to the longer one, an integer and a floating number to double, a
    decimal and an integer or decimal to a decimal of both ranges (double past 38
    digits); an integer and a time are a time; dates and timestamps a timestamp without
    zone; anything else is text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    i, j = _whole(a), _whole(b)
    if i is not None and j is not None:
        return _WHOLE[max(i, j)]
    floating = (T.FloatType, T.DoubleType)
    numbers = lambda t: isinstance(t, floating + (T.DecimalType,)) or _whole(t) is not None
    if numbers(a) and numbers(b):
        if isinstance(a, floating) or isinstance(b, floating):
            return T.DoubleType()
        (p, s), (q, r) = ((t.precision, t.scale) if isinstance(t, T.DecimalType) else (_WHOLE_DIGITS[_whole(t)], 0) for t in (a, b))
        scale = max(s, r)
        digits = max(p - s, q - r) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()
    if isinstance(a, _TIMES) and isinstance(b, _TIMES) or isinstance(a, _TIMES) and j is not None or isinstance(b, _TIMES) and i is not None:
        return T.TimestampNTZType()
    return T.StringType()


def widened_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns of all schemas, names compared without case, first spelling and
    first place kept."""
    found: dict[str, tuple[str, T.DataType]] = {}
    for f in (f for s in schemas for f in s.fields):
        name, kind = found.get(f.name.lower(), (f.name, T.NullType()))
        found[f.name.lower()] = (name, wider(kind, f.dataType))
    return T.StructType([T.StructField(n, t) for n, t in found.values()])


def _as(c: Column, source: T.DataType, target: T.DataType, epoch_unit: str) -> Column:
    if source == target:
        return c
    if isinstance(target, T.TimestampNTZType) and _whole(source) is not None:
        return F.timestamp_micros(c.cast("bigint") * F.lit(EPOCH_UNITS[epoch_unit])).cast(target)
    return c.cast(target)


def read_widened(spark: SparkSession, paths: Sequence[str], base_path: str | None = None, epoch_unit: str = "micros",
                 like: T.StructType | None = None) -> DataFrame:
    """The files and folders at ``paths`` as one DataFrame of the widened schema.

    Each path is one delivery, its files of one schema (else Spark's own merge decides).
    ``base_path`` keeps partition columns; ``like`` is one more schema to hold, such as
    the declared one.  Filters and column choices still reach
    every scan."""
    reader = lambda: spark.read.option("basePath", base_path) if base_path else spark.read
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    with ThreadPoolExecutor(max_workers=FOOTERS_AT_ONCE) as pool:
        found = list(pool.map(lambda p: reader().parquet(p).schema, paths))
    for p, schema in zip(paths, found):
        groups.setdefault(schema.json(), (schema, []))[1].append(p)
    target = widened_schema([*([like] if like else []), *[s for s, _ in groups.values()]])
    out = None
    for schema, same in groups.values():
        own = {f.name.lower(): f for f in schema.fields}
        df = reader().schema(schema).parquet(*same)
        part = df.select(*[
            _as(F.col(f"`{own[f.name.lower()].name}`"), own[f.name.lower()].dataType, f.dataType, epoch_unit).alias(f.name)
            if f.name.lower() in own else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields])
        out = part if out is None else out.unionByName(part)
    return out


def conflicts(schemas: Sequence[T.StructType]) -> dict[str, list[str]]:
    """Columns with more than one type, and their types, for a delivery report."""
    seen: dict[str, dict[str, None]] = defaultdict(dict)
    for f in (f for s in schemas for f in s.fields):
        seen[f.name.lower()][f.dataType.simpleString()] = None
    return {c: list(t) for c, t in seen.items() if len(t) > 1}
