import glob
import os

import pytest
from pyspark.sql import functions as F

from arrivals_mart.operators import publish as P
from arrivals_mart.operators.keymap import extend_key_map, with_stable_key
from arrivals_mart.operators.sinks import overwrite_partitions
from arrivals_mart.schemas import ContractError

SCHEMA = "y int, m int, k string, n bigint"


def rows_of(df):
    return sorted(map(tuple, df.select("y", "m", "k", "n").collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


FIRST = [(2016, 1, "a", 1), (2016, 2, "b", 2), (None, 2, "c", 3)]
SECOND = [(2016, 2, "d", 4), (2016, 3, "e", 5)]


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_dynamic_overwrite_replaces_only_the_delivered_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_partitions(frame(spark, FIRST), path, ["y", "m"])
    before = files(path)
    overwrite_partitions(frame(spark, SECOND), path, ["y", "m"])
    assert rows_of(spark.read.schema(SCHEMA).parquet(path)) == rows_of(frame(spark, [FIRST[0], FIRST[2], *SECOND]))
    kept = {f for f in before if "y=2016/m=2" not in f}
    assert len(kept) == 2 and all(files(path)[f] == before[f] for f in kept)


def test_dynamic_overwrite_spreads_a_large_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(4000).select(F.lit(2016).alias("y"), F.lit(1).alias("m"), F.col("id").cast("string").alias("k"), F.col("id").alias("n"))
    with_aqe = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        overwrite_partitions(df, path, ["y", "m"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_aqe)
    assert 1 < len(files(path)) <= 16 and spark.read.parquet(path).count() == 4000


@pytest.mark.parametrize("partition_by", [[], ["y", "m"]])
def test_versions_are_published_and_read(spark, tmp_path, partition_by):
    target = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        P.read_published(spark, target)
    one = P.publish(frame(spark, FIRST), target, partition_by=partition_by, key="k")
    two = P.publish(frame(spark, SECOND), target, partition_by=partition_by, key="k")
    assert (one.version, two.version, P.versions(spark, target)) == (1, 2, [1, 2])
    assert rows_of(P.read_published(spark, target)) == rows_of(frame(spark, SECOND))
    assert rows_of(P.read_published(spark, target, 1)) == rows_of(frame(spark, FIRST))
    assert P.read_published(spark, target).columns == ["y", "m", "k", "n"]


def test_a_delivery_replaces_its_months_and_keeps_the_files_of_others(spark, tmp_path):
    target = str(tmp_path / "t")
    P.publish(frame(spark, FIRST), target, partition_by=["y", "m"])
    before = files(target)
    P.publish(frame(spark, SECOND), target, partition_by=["y", "m"], keep_others=True)
    assert rows_of(P.read_published(spark, target)) == rows_of(frame(spark, [FIRST[0], FIRST[2], *SECOND]))
    assert before.items() <= files(target).items()
    pruned = P.read_published(spark, target).filter("m = 3")
    assert [r.k for r in pruned.collect()] == ["e"] and "PartitionFilters: [isnotnull(m" in pruned._jdf.queryExecution().toString()
    with pytest.raises(ContractError, match="published by"):
        P.publish(frame(spark, SECOND), target, keep_others=True)


def _lost():
    raise InterruptedError("lost")


def test_a_load_that_fails_leaves_the_old_rows(spark, tmp_path):
    target = str(tmp_path / "t")
    P.publish(frame(spark, FIRST), target, partition_by=["y", "m"])
    with pytest.raises(InterruptedError):
        P.publish(frame(spark, SECOND), target, partition_by=["y", "m"], before_publishing=_lost)
    with pytest.raises(ContractError, match="k is null in 1 rows"):
        P.publish(frame(spark, [*SECOND, (2017, 1, None, 9)]), target, partition_by=["y", "m"], key="k")
    assert rows_of(P.read_published(spark, target)) == rows_of(frame(spark, FIRST))
    assert P.versions(spark, target) == [1]


def test_a_load_overtaken_by_another_raises(spark, tmp_path):
    target = str(tmp_path / "t")

    def other():
        P.publish(frame(spark, SECOND), target)

    with pytest.raises(P.ConcurrentPublication):
        P.publish(frame(spark, FIRST), target, before_publishing=other)
    assert rows_of(P.read_published(spark, target)) == rows_of(frame(spark, SECOND))
    assert [f for f in os.listdir(f"{target}/manifests") if not f.endswith(".crc")] == ["0000000001.json"]


def test_old_versions_and_remains_go(spark, tmp_path):
    target = str(tmp_path / "t")
    for rows in (FIRST, SECOND, FIRST):
        P.publish(frame(spark, rows), target, partition_by=["y", "m"], keep_others=True)
    with pytest.raises(InterruptedError):
        P.publish(frame(spark, SECOND), target, partition_by=["y", "m"], before_publishing=_lost)
    want = rows_of(P.read_published(spark, target))
    assert P.remove_old_versions(spark, target, keep=1) == []  # too young
    gone = P.remove_old_versions(spark, target, keep=1, min_age_s=0)
    # of the first load all three months were replaced, of the second one, and two are of the failed load
    assert len(gone) == 6 and P.versions(spark, target) == [3]
    assert rows_of(P.read_published(spark, target)) == want
    assert len(files(target)) == 4


def test_empty_loads(spark, tmp_path):
    target = str(tmp_path / "t")
    P.publish(frame(spark, []), target, partition_by=["y", "m"], key="k")
    assert P.read_published(spark, target).count() == 0 and P.read_published(spark, target).columns == ["y", "m", "k", "n"]
    P.publish(frame(spark, FIRST), target, partition_by=["y", "m"], keep_others=True)
    P.publish(frame(spark, []), target, partition_by=["y", "m"], keep_others=True)
    assert rows_of(P.read_published(spark, target)) == rows_of(frame(spark, FIRST))


def test_ids_survive_reruns(spark, tmp_path):
    path = str(tmp_path / "map")

    def cities(*names):
        return spark.createDataFrame([(c, s, i) for i, (c, s) in enumerate(names)], "city string, state string, n int")

    first = cities(("b", "X"), ("d", None), ("b", "X"), (None, "Y"))
    ids = {(r.city, r.state): r.id for r in with_stable_key(first, ["city", "state"], path, "id").collect()}
    assert ids == {(None, "Y"): 1, ("b", "X"): 2, ("d", None): 3}
    second = cities(("a", "X"), ("b", "X"), ("d", None), ("c", None), ("a", None))
    out = with_stable_key(second, ["city", "state"], path, "id")
    assert out.columns == ["city", "state", "n", "id"]
    later = {(r.city, r.state): r.id for r in out.collect()}
    assert later == {("b", "X"): 2, ("d", None): 3, ("a", None): 4, ("a", "X"): 5, ("c", None): 6}
    assert P.versions(spark, path) == [1, 2]
    whole = extend_key_map(first, ["city", "state"], path, "id")  # nothing new: no new version
    assert P.versions(spark, path) == [1, 2] and sorted(r.id for r in whole.collect()) == [1, 2, 3, 4, 5, 6]
    assert {r.key_batch for r in whole.collect()} == {1, 2}
