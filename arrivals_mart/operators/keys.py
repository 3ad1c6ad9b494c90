"""Dense surrogate keys.

``row_number() over (order by k1, k2, ...)`` without a partition clause runs
in one task over all rows. The same numbers are produced here in parallel:

1. range-partition the rows on the full ordering key and sort each
   partition, so partition i holds the i-th slice of the global order
   (range bounds come from a sample of the full composite key, so one hot
   leading value is still spread over many partitions);
2. number rows inside each partition from the scan position, and freeze
   (partition, position) by writing the rows as parquet to shared scratch: the
   range bounds come from a random sample, so two evaluations of the shuffle
   could disagree; both uses below read the same stored rows, also when
   executors are lost and tasks rerun;
3. count rows per partition; a running sum over those counts (one row per
   partition, a bounded table) gives each partition's offset;
4. key = offset + position + 1, with the offsets broadcast.

Rows that tie on the ordering key are ordered by a hash of all their
columns (unless ``tie_breakers`` are given), so their numbers are
deterministic and a key shared by many rows is still spread over several
range partitions. Only rows equal in every column share a hash; their
order among themselves does not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrivals_mart.session import stored

_ROW_BITS = 33  # monotonically_increasing_id = (partition index << 33) + row index


def dense_key(
    df: DataFrame,
    order_cols: Sequence[str],
    name: str,
    num_partitions: int | None = None,
    tie_breakers: Sequence[str] = (),
    start: int = 1,
) -> DataFrame:
    """Add ``name`` = 1-based position of each row in the order of ``order_cols``.

    Nulls sort first and every column ascends, as in Spark's ``ORDER BY``.
    The key is a bigint; the result keeps every input column.
    """
    if not tie_breakers:
        df = df.withColumn("_dk_tie", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
        tie_breakers = ["_dk_tie"]
    order = [F.col(c).asc_nulls_first() for c in [*order_cols, *tie_breakers]]
    # without an explicit count AQE may merge adjacent (still ordered) ranges,
    # so a small dimension is not spread over thousands of tiny partitions
    ranged = (
        (df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order))
        .sortWithinPartitions(*order)
        .withColumn("_dk_part", F.spark_partition_id())
        .withColumn("_dk_pos", F.monotonically_increasing_id())
    )
    ranged = ranged.withColumn(
        "_dk_pos", F.col("_dk_pos") - F.shiftleft(F.col("_dk_part").cast("bigint"), _ROW_BITS)
    )
    ranged = stored(ranged, "dense-key")
    sizes = ranged.groupBy("_dk_part").agg(F.count(F.lit(1)).alias("_dk_n"))
    before = Window.orderBy("_dk_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_dk_part", F.coalesce(F.sum("_dk_n").over(before), F.lit(0)).alias("_dk_offset"))
    # one row per range partition: a bounded table
    keyed = ranged.join(F.broadcast(offsets), "_dk_part")
    return keyed.withColumn(name, F.col("_dk_offset") + F.col("_dk_pos") + F.lit(start)).drop(
        "_dk_part", "_dk_pos", "_dk_offset", "_dk_tie"
    )
