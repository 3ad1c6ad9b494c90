"""Atomic publication (K1, K3): immutable data folders and a numbered manifest that points at them.

A load never touches what readers see. Its rows go to folders of their own,
``<target>/data/[<partition>/...]load=<id>``, which are checked there; then a manifest, a
small file that names the folder of every partition, is put in place under the next number.
Readers resolve the manifest with the highest number. A load that fails anywhere before
leaves folders that no manifest names, so the old rows stay what is read; old versions and
such remains are removed later.

The manifest is written under another name and renamed. A rename of one small file that must not
exist yet is atomic on a file system, and on an object store it is a copy that appears whole. Two loads at a time
get one number only once where renames don't replace; the loser raises and can be repeated. On
a store whose renames do replace, run one load at a time.

With ``partition_by`` a load replaces the partitions that it has rows for (a month that arrives anew) and
keeps the others' folders as they are.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals_mart.operators.quality import counted
from arrivals_mart.schemas import ContractError, enforce, schema_differences

LOAD_COLUMN = "load"


class ConcurrentPublication(RuntimeError):
    """Another load published the same version first; nothing of this load is visible."""


@dataclass(frozen=True)
class Manifest:
    """``parts`` maps a partition's folder (empty without partitions) to the load that holds its rows."""

    version: int
    partition_by: list[str]
    parts: dict[str, str]
    schema: str

    def text(self) -> str:
        return json.dumps(vars(self), indent=1, sort_keys=True)

    def folders(self, target: str) -> list[str]:
        return [f"{target}/data/{part}{'/' if part else ''}{LOAD_COLUMN}={load}" for part, load in self.parts.items()]


class _Files:
    """The few file operations of the file system that ``root`` lies on."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, pattern: str) -> list[tuple[str, int]]:
        """(full path, modification time in ms) of what matches."""
        found = self._fs.globStatus(self._path(pattern))
        return [(f.getPath().toString(), f.getModificationTime()) for f in found] if found else []

    def write(self, path: str, text: str) -> None:
        out = self._fs.create(self._path(path), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def rename(self, source: str, to: str) -> bool:
        return not self._fs.exists(self._path(to)) and self._fs.rename(self._path(source), self._path(to))

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def _number(path: str) -> int:
    return int(path.rsplit("/", 1)[1].removesuffix(".json"))


def versions(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the published versions, oldest first."""
    return sorted(_number(p) for p, _ in _Files(spark, target).names(f"{target.rstrip('/')}/manifests/[0-9]*.json"))


def manifest(spark: SparkSession, target: str, version: int | None = None) -> Manifest | None:
    """The manifest of ``version``, by default the newest; None where nothing is published."""
    if version is None:
        version = max(versions(spark, target), default=None)
        if version is None:
            return None
    path = f"{target.rstrip('/')}/manifests/{version:010d}.json"
    return Manifest(**json.loads(spark.read.text(path, wholetext=True).first()[0]))


def read_published(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The rows of a published version. Filters on partition columns prune folders."""
    target, found = target.rstrip("/"), manifest(spark, target, version)
    if found is None:
        raise FileNotFoundError(f"nothing is published at {target}")
    schema = T.StructType.fromJson(json.loads(found.schema))
    if not found.parts:
        return spark.createDataFrame([], schema)
    with_load = T.StructType([*schema.fields, T.StructField(LOAD_COLUMN, T.StringType())])
    rows = spark.read.schema(with_load).option("basePath", f"{target}/data").parquet(*found.folders(target))
    return rows.select(*[f.name for f in schema.fields])


def publish(
    df: DataFrame,
    target: str,
    schema: T.StructType | None = None,
    name: str | None = None,
    partition_by: Sequence[str] = (),
    key: str | None = None,
    keep_others: bool = False,
    before_publishing: Callable[[], None] | None = None,
) -> Manifest:
    """Write ``df`` beside the published rows, check it, and publish it as the next version.

    ``schema`` is the contract to enforce (by default the rows' own schema). ``key`` must not be null: its nulls, like the
    rows, are counted while the rows are written. Without ``keep_others`` the new version has only the
    rows of ``df``; with it partitions that ``df`` has no rows for stay. ``before_publishing`` is called
    when the rows are written and checked; what it raises ends the load.
    """
    spark, target, label = df.sparkSession, target.rstrip("/"), name or target
    schema = schema or T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    rows = enforce(df, schema, label, check_nulls=False)
    load, files, old = uuid.uuid4().hex[:16], _Files(spark, target), manifest(spark, target)
    if old and keep_others and old.partition_by != list(partition_by):
        raise ContractError(f"{label}: published by {old.partition_by}, not by {list(partition_by)}")
    observed, counts = counted(rows, key)
    # dynamic overwrite stages each job apart; only the folders of this load are new
    observed.withColumn(LOAD_COLUMN, F.lit(load)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *partition_by, LOAD_COLUMN).parquet(f"{target}/data")
    folders = [p for p, _ in files.names(f"{target}/data/{'*/' * len(partition_by)}{LOAD_COLUMN}={load}")]
    arrived = {"/".join(p.split("/")[-1 - len(partition_by):-1]): load for p in folders}
    _check(spark, target, schema, list(partition_by), folders, label)
    if key and counts().get("null_keys"):
        raise ContractError(f"{label}.{key} is null in {counts()['null_keys']} rows")
    if before_publishing:
        before_publishing()
    parts = ((old.parts if old and keep_others else {}) | arrived)
    new = Manifest((old.version if old else 0) + 1, list(partition_by), parts, schema.json())
    _put(files, target, new)
    return new


def _check(spark: SparkSession, target: str, schema: T.StructType, partition_by: list[str], folders: list[str], label: str) -> None:
    """What was written has the contract's columns (partition columns are in the folders' names)."""
    if folders:
        written = spark.read.option("basePath", f"{target}/data").parquet(*folders).drop(LOAD_COLUMN, *partition_by).schema
        diffs = schema_differences(written, T.StructType([f for f in schema if f.name not in partition_by]))
        if diffs:
            raise ContractError(f"{label}: schema differs from contract: {diffs}")


def _put(files: _Files, target: str, new: Manifest) -> None:
    staged, final = f"{target}/manifests/.{uuid.uuid4().hex}", f"{target}/manifests/{new.version:010d}.json"
    files.write(staged, new.text())
    if not files.rename(staged, final):
        files.remove(staged)
        raise ConcurrentPublication(f"version {new.version} of {target} was published by another load")


def remove_old_versions(spark: SparkSession, target: str, keep: int = 2, min_age_s: float = 24 * 3600) -> list[str]:
    """Remove all but the newest ``keep`` versions, and folders that no kept version names.

    Nothing younger than ``min_age_s`` goes: it may belong to a load that is running or a reader that is reading.
    Returns the removed folders.
    """
    target, files = target.rstrip("/"), _Files(spark, target)
    numbers, until = versions(spark, target), (time.time() - min_age_s) * 1000
    kept = [manifest(spark, target, n) for n in numbers[-keep:]]
    named, depth = {f for m in kept for f in m.folders("")}, {len(m.partition_by) for m in kept}
    for path, changed in files.names(f"{target}/manifests/[0-9]*.json"):
        if _number(path) in numbers[:-keep] and changed <= until:
            files.remove(path)
    gone = [
        path for d in depth for path, changed in files.names(f"{target}/data/{'*/' * d}{LOAD_COLUMN}=*")
        if "/" + path[path.rindex("/data/") + 1:] not in named and changed <= until
    ]
    for path in gone:
        files.remove(path)
    return gone
