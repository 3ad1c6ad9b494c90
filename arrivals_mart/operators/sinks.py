"""Sinks (K1, K3).

``overwrite`` replaces a parquet folder, ``overwrite_partitions`` only the partitions that arrived. ``truncate_and_load`` replaces the
content of a target (catalog table or folder) with staged parquet, columns
taken in contract order; any failure raises.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals_mart.schemas import (
    RECORD_KEY_TABLES,
    TABLE_KEYS,
    TARGETS,
    ContractError,
    ddl,
    enforce,
    schema_differences,
)
from arrivals_mart.session import stored

#: Tasks that write one partition of ``overwrite_partitions`` at most.
WRITERS_PER_PARTITION = 16


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write ``df`` as parquet at ``path``, replacing what was there."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions that ``df`` has rows for; the files of all others stay untouched.

    Rows are dealt by their partition and a hash, so that a partition is written by some tasks into files of
    good size, not by every task, and a large partition not by one. A job that fails leaves the partitions as they were.
    """
    by = [F.col(c) for c in partition_by]
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(WRITERS_PER_PARTITION))
    df.repartition(*by, spread).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *partition_by).parquet(path)


def write_contract(
    df: DataFrame, path: str, schema: T.StructType, name: str, check_nulls: bool = True,
    observe: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Enforce the target contract, then overwrite ``path``. ``observe`` may attach counts to the rows that are written."""
    rows = enforce(df, schema, name, check_nulls)
    overwrite(observe(rows) if observe else rows, path)


def _check_schema(actual: T.StructType, schema: T.StructType, label: str) -> None:
    diffs = schema_differences(actual, schema)
    if diffs:
        raise ContractError(f"{label}: schema differs from contract: {diffs}")


def _replace_folder(spark: SparkSession, rows: DataFrame, target: str, schema: T.StructType, label: str) -> None:
    """Write ``rows`` beside ``target``, check them there, and only then put them in its place."""
    target = target.rstrip("/")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    mark = uuid.uuid4().hex[:12]
    fresh, old = f"{target}.loading-{mark}", f"{target}.replaced-{mark}"
    try:
        rows.write.parquet(fresh)
        _check_schema(spark.read.parquet(fresh).schema, schema, label)
        had = fs.exists(path(target))
        if had and not fs.rename(path(target), path(old)):
            raise OSError(f"{label}: cannot move {target} aside")
        if not fs.rename(path(fresh), path(target)):
            if had:
                fs.rename(path(old), path(target))
            raise OSError(f"{label}: cannot move the loaded rows to {target}")
    finally:
        if fs.exists(path(fresh)):
            fs.delete(path(fresh), True)
    if had:
        fs.delete(path(old), True)
    spark.catalog.refreshByPath(target)


def truncate_and_load(
    spark: SparkSession,
    staged_path: str,
    target: str,
    schema: T.StructType,
    name: str | None = None,
    source_format: str = "parquet",
    options: dict[str, str] | None = None,
    check_nulls: bool = True,
    observe: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Replace ``target`` with the staged files at ``staged_path``.

    ``source_format`` and ``options`` describe the staged files (parquet by
    default; e.g. ``"csv"`` with ``{"header": "true"}``), typed files are
    read as they are and text formats are read with the contract's schema.
    ``target`` is a parquet folder when it contains a ``/``, otherwise an
    existing catalog table (rows are inserted by position after an
    overwrite); a missing table is an error.

    The target keeps its old rows until the new ones are written and checked: a
    folder is written beside the old one and swapped in; a table's schema is
    compared with the contract first, and its rows are written to scratch,
    where null keys show, before they are inserted.
    ``observe`` may attach counts to the rows that are written. Returns the loaded target as a DataFrame.
    """
    label = name or target
    reader = spark.read.format(source_format).options(**(options or {}))
    if source_format in ("csv", "json", "text"):
        reader = reader.schema(schema)
    staged = reader.load(staged_path)
    rows = enforce(staged, schema, label, check_nulls)
    rows = observe(rows) if observe else rows
    if "/" not in target:
        if not spark.catalog.tableExists(target):
            raise ValueError(f"{label}: no table {target!r}; create it with create_targets or pass a folder path")
        _check_schema(spark.table(target).schema, schema, label)
        stored(rows, "load").write.insertInto(target, overwrite=True)
        return spark.table(target)
    _replace_folder(spark, rows, target, schema, label)
    return spark.read.parquet(target)


def create_targets(
    spark: SparkSession,
    location_root: str | None = None,
    database: str | None = None,
    targets: dict[str, T.StructType] = TARGETS,
    buckets: int | None = None,
) -> list[str]:
    """Create the target tables in the session catalog (K2); returns their names.

    With ``location_root`` each table lives in ``<root>/<table>``, so the
    files stay on the shared filesystem the cluster reads from. With
    ``buckets`` the tables keyed by the arrival record are bucketed and
    sorted by that key into the same number of buckets, so joining them
    needs no shuffle.
    """
    names = []
    for table, schema in targets.items():
        name = f"{database}.{table}" if database else table
        loc = f"{location_root.rstrip('/')}/{table}" if location_root else None
        bucket_by = (TABLE_KEYS[table], buckets) if buckets and table in RECORD_KEY_TABLES else None
        spark.sql(ddl(name, schema, loc, bucket_by))
        names.append(name)
    return names
