"""File sources.

Readers always take a declared schema: parquet keeps its own types (the
schema only prunes and orders), CSV is read all-string and typed later with
the tolerant casts. Paths may be any Hadoop filesystem URI.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None, recursive: bool = False
) -> DataFrame:
    """Parquet directory or glob -> DataFrame.

    ``recursive`` also finds files in sub-folders (a delivery folder holding
    one sub-folder of hashed file names); partition columns are then not
    inferred from folder names. Other files of a delivery (notes, markers)
    are left out; a single file may be named by its path whatever its suffix.
    """
    reader = spark.read
    if recursive:
        reader = reader.option("pathGlobFilter", "*.parquet")
    if schema is not None:
        reader = reader.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.parquet(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    sep: str = ",",
) -> DataFrame:
    """CSV with a header line -> all-string DataFrame.

    With a schema its columns are taken by header name (in any letter case),
    wherever they stand; other columns are left out and a missing one raises.
    All files of a folder must share one header order: Spark checks each
    against the first (``enforceSchema`` off), so columns never shift silently.
    Without a schema every column is a string named after its header.
    """
    reader = spark.read.option("header", "true").option("sep", sep).option("mode", "PERMISSIVE")
    found = reader.csv(path)
    if schema is None:
        return found
    by_lower = {c.strip().lower(): c for c in reversed(found.columns)}
    missing = [f.name for f in schema.fields if f.name.lower() not in by_lower]
    if missing:
        raise ValueError(f"{path}: no columns {missing} in header {found.columns}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in found.columns])
    rows = reader.schema(text).option("enforceSchema", "false").csv(path)
    return rows.select(*[F.col(f"`{by_lower[f.name.lower()]}`").alias(f.name) for f in schema.fields])


def rename_headers(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Header text -> snake case (P2). Names absent from ``df`` are ignored."""
    present = {old: new for old, new in mapping.items() if old in df.columns}
    return df.withColumnsRenamed(present)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``<base>/<name>.parquet`` -> DataFrame, for the driver's test tables."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def register(df: DataFrame, name: str) -> DataFrame:
    """Name a relation for SQL (S7); the DataFrame itself is returned for chaining."""
    df.createOrReplaceTempView(name)
    return df
