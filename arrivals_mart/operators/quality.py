"""Data-quality checks.

Tables that lie there already get one aggregate pass each, computing row count, null keys
and duplicated keys (``run_checks``). Rows that are being written are counted by the
write itself (``counted``), so that only uniqueness reads them again (``checked_report``).
``assert_checks`` raises with all failures at once (non-empty checks first, then null keys, then duplicates).

Uniqueness does not shuffle all keys (``duplicate_keys``): four bytes of a key's hash are packed into one
array per range of hashes, and only keys whose hash comes twice are shuffled and counted exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from arrivals_mart.operators.lookups import row_count_at_most
from arrivals_mart.session import stored

REPORT_COLUMNS = ["table_name", "key_column", "row_count", "null_keys", "duplicate_keys", "passed"]


def table_checks(df: DataFrame, table: str, key: str, unique: bool = True) -> DataFrame:
    """One report row for one table."""
    k = F.col(key)
    aggs = [
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(k.isNull()).alias("null_keys"),
    ]
    if unique:
        # keys that occur more than once, counted as surplus rows
        aggs.append((F.count(k) - F.count_distinct(k)).alias("duplicate_keys"))
    else:
        aggs.append(F.lit(0).cast("bigint").alias("duplicate_keys"))
    out = df.agg(*aggs)
    passed = (F.col("row_count") > 0) & (F.col("null_keys") == 0) & (F.col("duplicate_keys") == 0)
    return out.select(
        F.lit(table).alias("table_name"),
        F.lit(key).alias("key_column"),
        F.col("row_count").cast("bigint").alias("row_count"),
        F.col("null_keys").cast("bigint").alias("null_keys"),
        F.col("duplicate_keys").cast("bigint").alias("duplicate_keys"),
        passed.alias("passed"),
    )


def run_checks(tables: Mapping[str, tuple[DataFrame, str]], unique: bool = True) -> DataFrame:
    """``{table: (df, key)}`` -> report with one row per table."""
    parts = [table_checks(df, name, key, unique) for name, (df, key) in tables.items()]
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    return report


def assert_checks(report: DataFrame) -> list[dict]:
    """Collect the (one row per table) report and raise ValueError on any failure."""
    rows = [r.asDict() for r in report.collect()]
    problems = []
    for r in rows:
        if r["row_count"] is None or r["row_count"] < 1:
            problems.append(f"{r['table_name']} contained 0 rows")
    for r in rows:
        if r["null_keys"]:
            problems.append(f"{r['table_name']}.{r['key_column']} is null in {r['null_keys']} rows")
    for r in rows:
        if r["duplicate_keys"]:
            problems.append(f"{r['table_name']}.{r['key_column']} repeats in {r['duplicate_keys']} rows")
    if problems:
        raise ValueError("Data quality check failed: " + "; ".join(problems))
    return rows


def counted(df: DataFrame, key: str | None) -> tuple[DataFrame, Callable[[], dict]]:
    """``df`` whose rows, and null keys, are counted by the action that writes it; and the counts, once it ran."""
    observation = Observation()
    metrics = [F.count(F.lit(1)).alias("row_count")]
    if key:
        metrics.append(F.count_if(F.col(key).isNull()).alias("null_keys"))
    return df.observe(observation, *metrics), lambda: observation.get


def checked_report(spark: SparkSession, tables: Mapping[str, tuple[DataFrame, str, dict]], unique: bool = True) -> DataFrame:
    """``{table: (written table, key, counts of the write)}`` -> the report of :func:`run_checks`.

    Only the key columns are read again, and only if uniqueness is asked for. An empty
    plan may be optimized away together with its counts: it had no rows.
    """
    rows = []
    for name, (df, key, counts) in tables.items():
        n, nulls = counts.get("row_count") or 0, counts.get("null_keys") or 0
        surplus = surplus_rows(df, key, n) if unique and n else 0
        rows.append((name, key, n, nulls, surplus, n > 0 and nulls == 0 and surplus == 0))
    return spark.createDataFrame(
        rows, "table_name string, key_column string, row_count long, null_keys long, duplicate_keys long, passed boolean")


def surplus_rows(df: DataFrame, key: str, rows: int | None = None) -> int:
    """Rows beyond the first of each key that is not null."""
    repeated = duplicate_keys(df.filter(F.col(key).isNotNull()), [key], rows)
    return repeated.agg(F.sum(F.col("n") - 1)).first()[0] or 0


#: Hashes of a range: an array of so many four-byte numbers is gathered in one task.
RANGE_HASHES = 1 << 20
#: Suspected hashes that are broadcast; with more the keys themselves are counted.
MAX_SUSPECTS = 100_000


def _hash_parts(keys: Sequence[str], ranges: int) -> list:
    """(range, four bytes) of the hash of a key; equal keys have equal ones."""
    h = F.xxhash64(*[F.col(k) for k in keys])
    low = (h.bitwiseAND(F.lit(0xFFFFFFFF)) - F.lit(1 << 31)).cast("int")
    return [F.pmod(F.shiftrightunsigned(h, 32), F.lit(ranges)).alias("_range"), low.alias("_low")]


def suspected_hashes(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """(_range, _low) of hashes that occur more than once.

    Each task packs its hashes by range before the only exchange, so a row costs four bytes there, whatever its key.
    """
    ranges = max(1, -(-rows // RANGE_HASHES))
    packed = df.select(*_hash_parts(keys, ranges)).groupBy("_range").agg(F.collect_list("_low").alias("lows"))
    # dealt by range already: no further exchange
    each = packed.select("_range", F.explode("lows").alias("_low")).groupBy("_range", "_low").agg(F.count(F.lit(1)).alias("_n"))
    return each.filter("_n > 1").drop("_n")


def duplicate_keys(df: DataFrame, keys: Sequence[str], rows: int | None = None) -> DataFrame:
    """Key values that occur more than once, with their multiplicity ``n`` (D3).

    Nulls are values like others. ``rows`` is the number of rows of ``df`` if it is known already. Where most keys repeat,
    so that more hashes are suspected than are broadcast, all keys are counted directly.
    """
    rows = df.count() if rows is None else rows
    suspects = stored(suspected_hashes(df, keys, rows).limit(MAX_SUSPECTS + 1), "suspected-keys")
    counted_rows = df.select(*keys)
    if row_count_at_most(suspects, MAX_SUSPECTS):
        ranges = max(1, -(-rows // RANGE_HASHES))
        named = counted_rows.select("*", *_hash_parts(keys, ranges))
        counted_rows = named.join(F.broadcast(suspects), ["_range", "_low"], "left_semi").select(*keys)
    return counted_rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
