"""Windowed analytics: trailing calendar-month averages (W3) and top-k (L1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrivals_mart.functions.dates import month_index


def trailing_average(
    df: DataFrame,
    partition_cols: Sequence[str],
    month_col: str,
    value_col: str,
    months: int = 3,
    name: str = "trailing_avg",
) -> DataFrame:
    """Average of ``value_col`` over the current and previous ``months - 1`` calendar months.

    The frame is a RANGE over the month number, so missing months are not
    bridged: a row's frame only holds rows whose month lies within
    ``months`` calendar months. Input is expected at one row per
    (partition, month), i.e. already aggregated, so a window partition holds
    one row per month however many raw rows the partition key had.
    """
    w = (
        Window.partitionBy(*partition_cols)
        .orderBy(month_index(F.col(month_col)))
        .rangeBetween(-(months - 1), 0)
    )
    return df.withColumn(name, F.avg(value_col).over(w))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows in ``order`` (planned as a distributed take-ordered)."""
    return df.orderBy(*order).limit(k)
