"""Outer joins that stay balanced when many rows have a null key.

In an outer equi-join, rows whose key is null can never match, yet they are
shuffled by the hash of that null key, so all of them meet in one task. If a
third of the rows miss a key, one task gets a third of the data.

Here one string join key of the left side (the *carrier*) is replaced, on
rows whose keys are incomplete, by a scattered non-null text derived from
other columns of the row, and a flag column records whether the keys were
complete. The join uses the replaced carrier as its key and requires the
flag, so incomplete rows still find no partner but hash to all partitions.
Only the left side changes: a constant spread key on the right would be
folded by Catalyst into a join filter and vanish from the shuffle keys.
Hot non-null keys are split by AQE's skew-join handling.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals_mart.operators.lookups import sized_broadcast
from arrivals_mart.session import stored

COMPLETE = "_keys_complete"
_SCATTER_PREFIX = "\u0000incomplete-key:"


def spread_key(carrier: str) -> str:
    """Name of the replaced carrier column."""
    return f"_spread_{carrier}"


def spread_incomplete_keys(df: DataFrame, keys: Sequence[str], carrier: str, spread_by: Sequence[str]) -> DataFrame:
    """Add ``_keys_complete`` and the scattered carrier ``_spread_<carrier>`` to the left side.

    ``carrier`` must be one of ``keys`` and a string column; ``spread_by``
    names the columns whose hash scatters the incomplete rows.
    """
    if carrier not in keys or not isinstance(df.schema[carrier].dataType, T.StringType):
        raise ValueError(f"carrier {carrier!r} must be a string column among the join keys")
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    scatter = F.concat(F.lit(_SCATTER_PREFIX), F.xxhash64(*[F.col(c) for c in spread_by]).cast("string"))
    return df.withColumn(COMPLETE, complete).withColumn(
        spread_key(carrier), F.when(complete, F.col(carrier)).otherwise(scatter)
    )


def complete_condition(alias: str) -> Column:
    """Join condition part: only rows with complete keys may match."""
    return F.col(f"{alias}.{COMPLETE}")


HOT = "_hot_key"
SALT = "_salt"


def salt_hot_right_keys(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    hot_threshold: int,
    salts: int,
    max_hot_keys: int = 100_000,
) -> tuple[DataFrame, DataFrame]:
    """Prepare a left outer join whose right side may hold many copies of one key.

    Right keys with at least ``hot_threshold`` rows are hot. Their right rows
    are spread over ``salts`` buckets by a row hash, and the left rows with a
    hot key are repeated once per bucket; all other rows get salt 0. Join on
    the keys plus ``_salt`` and drop with :func:`drop_unmatched_hot_replicas`
    the replicas that met an empty bucket: a hot key always has right rows,
    so every hot left row still gets all its matches, each exactly once.

    The list of hot keys is counted once and stored; when it is empty both
    sides get salt 0 and nothing else happens to them.
    """
    hot = (
        right.groupBy(*right_keys)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .filter(F.col("_copies") >= hot_threshold)
        .select(*[F.col(k).alias(f"_hot_{i}") for i, k in enumerate(right_keys)], F.lit(True).alias(HOT))
    )
    hot = stored(hot, "hot-keys")
    if hot.isEmpty():
        return left.withColumns({HOT: F.lit(False), SALT: F.lit(0)}), right.withColumn(SALT, F.lit(0))
    hot = sized_broadcast(hot, max_hot_keys)  # at most |right| / hot_threshold rows

    def mark(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_hot_{i}") for i, k in enumerate(keys)])
        marked = df.join(hot, cond, "left").drop(*[f"_hot_{i}" for i in range(len(keys))])
        return marked.withColumn(HOT, F.coalesce(F.col(HOT), F.lit(False)))

    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    left_salted = mark(left, left_keys).withColumn(
        SALT, F.explode(F.when(F.col(HOT), every_salt).otherwise(F.array(F.lit(0))))
    )
    right_marked = mark(right, right_keys)
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in right.columns])
    right_salted = right_marked.withColumn(
        SALT, F.when(F.col(HOT), F.pmod(row_hash, F.lit(salts))).otherwise(F.lit(0)).cast("int")
    ).drop(HOT)
    return left_salted, right_salted


def salt_condition(left_alias: str, right_alias: str) -> Column:
    return F.col(f"{left_alias}.{SALT}") == F.col(f"{right_alias}.{SALT}")


def drop_unmatched_hot_replicas(joined: DataFrame, left_alias: str, right_alias: str) -> DataFrame:
    """Remove replicas of hot left rows that found no right row in their bucket."""
    return joined.filter(~(F.col(f"{left_alias}.{HOT}") & F.col(f"{right_alias}.{SALT}").isNull()))
