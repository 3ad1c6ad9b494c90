"""Surrogate keys that survive reruns (W1, W2): a published map from natural keys to ids.

``dense_key`` numbers the rows of one run, so a city that is added moves the ids of all cities after it. Here an id
is given once: every run looks up the natural keys it has, numbers only those that the map lacks, from the
greatest id on, and publishes them as a further part of the map. Old parts are not written again, and
as the map is published atomically a run that fails leaves the ids as they were.

Natural keys may hold nulls; null is a value like others.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivals_mart.operators.keys import dense_key
from arrivals_mart.operators.publish import publish, read_published, versions
from arrivals_mart.session import stored

#: Number of the run that gave an id: a partition of the map.
BATCH = "key_batch"


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [left[k].eqNullSafe(right[k]) for k in keys])


def extend_key_map(rows: DataFrame, keys: Sequence[str], map_path: str, name: str) -> DataFrame:
    """Give every natural key of ``rows`` that has none an id, in the order of ``keys``; return the whole map.

    The map has the columns ``keys``, ``name`` (bigint, from 1 on without gaps) and ``key_batch``.
    """
    spark = rows.sparkSession
    found = rows.select(*keys).distinct()
    batch = max(versions(spark, map_path), default=0) + 1
    greatest = 0
    if batch > 1:
        old = read_published(spark, map_path)
        greatest = old.agg(F.max(name)).first()[0] or 0
        found = found.join(old, _same(found, old, keys), "left_anti")
    fresh = stored(found, "key-map-fresh")
    if batch == 1 or not fresh.isEmpty():
        numbered = dense_key(fresh, keys, name, start=greatest + 1).withColumn(BATCH, F.lit(batch))
        publish(numbered, map_path, partition_by=[BATCH], key=name, keep_others=True)
    return read_published(spark, map_path)


def with_stable_key(rows: DataFrame, keys: Sequence[str], map_path: str, name: str) -> DataFrame:
    """``rows`` with the id of their natural key as the column ``name``."""
    ids = extend_key_map(rows, keys, map_path, name).drop(BATCH).withColumnsRenamed({k: f"_map_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_map_{k}`")) for k in keys])
    return rows.join(ids, same).drop(*[f"_map_{k}" for k in keys])
