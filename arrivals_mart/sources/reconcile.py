"""Deliveries whose schemas differ (S1, K4): one schema for all, and a report of what differs.

A delivery is a file or folder of parquet files, such as one month of arrivals. The schemas of the
files' footers are merged into one; no rows are read for that. Columns are matched without regard to case
and stand in the order of their first appearance. The rules:

- A column that a delivery lacks reads as null there.
- byte, short, int and long widen to the longest of them, float and double to double.
- An integral and a floating type make double (a long beyond 2^53 is rounded there, as in Spark's own widening).
- Decimals widen to the digits that both need, up to 38; decimals and integral types likewise.
- A date and a timestamp make a timestamp (with the zone rules of the timestamp's type).
- Any other pair of types reads as string.

Every file is read with its own schema and then cast, so no reader has to convert types that
the file format doesn't convert.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}
_TIMES = (T.TimestampType(), T.TimestampNTZType())

REPORT_SCHEMA = "delivery string, column_name string, difference string, found string, read_as string"


def _decimal(a: tuple[int, int], b: tuple[int, int]) -> T.DecimalType:
    scale = max(a[1], b[1])
    whole = max(a[0] - a[1], b[0] - b[1])
    return T.DecimalType(min(38, whole + scale), min(scale, max(0, 38 - whole)))


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that both are read as."""
    if a == b:
        return a
    floats = (T.FloatType(), T.DoubleType())
    if a in _INTEGRAL and b in _INTEGRAL:
        return _INTEGRAL[max(_INTEGRAL.index(a), _INTEGRAL.index(b))]
    if a in floats and b in floats:
        return T.DoubleType()
    if (a in floats and b in _INTEGRAL) or (b in floats and a in _INTEGRAL):
        return T.DoubleType()
    numbers = [x for x in (a, b) if isinstance(x, T.DecimalType) or x in _INTEGRAL]
    if len(numbers) == 2:
        sizes = [(x.precision, x.scale) if isinstance(x, T.DecimalType) else (_DIGITS[x.simpleString()], 0) for x in numbers]
        return _decimal(*sizes)
    if T.DateType() in (a, b) and (a in _TIMES or b in _TIMES):
        return a if a in _TIMES else b
    return T.StringType()


def reconcile(schemas: Mapping[str, T.StructType]) -> tuple[T.StructType, list[tuple]]:
    """One schema for all deliveries, and rows of the report (delivery, column, difference, found, read as)."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas.values():
        for f in schema:
            known = fields.get(f.name.lower())
            fields[f.name.lower()] = T.StructField(known.name if known else f.name, wider(known.dataType, f.dataType) if known else f.dataType)
    # a type that was widened later may widen further together with an earlier one
    for schema in schemas.values():
        for f in schema:
            known = fields[f.name.lower()]
            fields[f.name.lower()] = T.StructField(known.name, wider(known.dataType, f.dataType))
    first = {f.name.lower() for f in next(iter(schemas.values()), T.StructType())}
    report = []
    for delivery, schema in schemas.items():
        own = {f.name.lower(): f for f in schema}
        for low, f in fields.items():
            as_ = f.dataType.simpleString()
            if low not in own:
                report.append((delivery, f.name, "missing", None, as_))
            elif low not in first:
                report.append((delivery, f.name, "added", own[low].dataType.simpleString(), as_))
            elif own[low].dataType != f.dataType:
                report.append((delivery, f.name, "retyped", own[low].dataType.simpleString(), as_))
    return T.StructType(list(fields.values())), report


def read_deliveries(spark: SparkSession, paths: Mapping[str, str], wanted: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, report) of the deliveries ``{name: path}``; rows have the reconciled schema and a column ``delivery``.

    ``wanted`` leaves out other columns (before they are read). A delivery's files may differ
    among themselves where parquet's own schema merging can join them.
    """
    read = {name: spark.read.option("mergeSchema", "true").option("pathGlobFilter", "*.parquet").parquet(path)
            for name, path in paths.items()}
    schema, report = reconcile({name: df.schema for name, df in read.items()})
    if wanted is not None:
        chosen = {c.lower() for c in wanted}
        schema = T.StructType([f for f in schema if f.name.lower() in chosen])
        report = [r for r in report if r[1].lower() in chosen]
    parts = []
    for name, df in read.items():
        own = {c.lower(): c for c in df.columns}
        columns = [
            (F.col(f"`{own[f.name.lower()]}`") if f.name.lower() in own else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
        parts.append(df.select(*columns, F.lit(name).alias("delivery")))
    return reduce(DataFrame.unionByName, parts), spark.createDataFrame(report, REPORT_SCHEMA)
