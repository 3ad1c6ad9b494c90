import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals_mart.operators import quality
from arrivals_mart.operators.quality import assert_checks, checked_report, counted, duplicate_keys, run_checks, surplus_rows
from arrivals_mart.operators.sinks import create_targets, overwrite, truncate_and_load
from arrivals_mart.schemas import ContractError, enforce, schema_differences

CONTRACT = T.StructType(
    [T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType()), T.StructField("n", T.IntegerType())]
)


def test_checks_report_and_raise_with_all_failures(spark):
    good = spark.createDataFrame([(1,), (2,)], "k long")
    empty = spark.createDataFrame([], "k long")
    bad = spark.createDataFrame([(1,), (1,), (None,)], "k long")
    report = run_checks({"good": (good, "k"), "empty": (empty, "k"), "bad": (bad, "k")})
    got = {r.table_name: (r.row_count, r.null_keys, r.duplicate_keys, r.passed) for r in report.collect()}
    assert got == {"good": (2, 0, 0, True), "empty": (0, 0, 0, False), "bad": (3, 1, 1, False)}
    with pytest.raises(ValueError) as e:
        assert_checks(report)
    msg = str(e.value)
    assert "empty contained 0 rows" in msg and "bad.k is null in 1 rows" in msg and "repeats in 1 rows" in msg
    assert msg.index("0 rows") < msg.index("is null")  # row-count failures first
    assert assert_checks(run_checks({"good": (good, "k")}))[0]["passed"]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (2, 1), (2, 1)], "a long, b long")
    assert sorted(tuple(r) for r in duplicate_keys(df, ["a", "b"]).collect()) == [(1, 1, 2), (2, 1, 3)]


def test_enforce_orders_casts_and_checks(spark, tmp_path):
    df = spark.createDataFrame([("x", 5, 1, "extra")], "NAME string, n long, id long, other string")
    out = enforce(df, CONTRACT, "t")
    assert out.columns == ["id", "name", "n"]
    assert schema_differences(out.schema, CONTRACT) == []
    with pytest.raises(ContractError):
        enforce(df.drop("n"), CONTRACT, "t")
    nulls = spark.createDataFrame([(None, "x", 1)], "id long, name string, n int")
    with pytest.raises(Exception) as e:
        overwrite(enforce(nulls, CONTRACT, "t"), str(tmp_path / "nulls"))
    assert "t.id is null" in str(e.value)


def test_overwrite_and_truncate_and_load_replace(spark, tmp_path):
    path, target = str(tmp_path / "staged"), str(tmp_path / "target")
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id long, name string, n int")
    overwrite(df.withColumn("n", F.lit(9)), path)
    overwrite(df, path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a", 1), (2, "b", 2)]
    truncate_and_load(spark, path, target, CONTRACT, "t")
    loaded = truncate_and_load(spark, path, target, CONTRACT, "t")
    assert loaded.count() == 2 and loaded.columns == ["id", "name", "n"]


def test_create_targets_and_load_into_catalog_table(spark, tmp_path):
    names = create_targets(spark, str(tmp_path / "wh"), targets={"t_contract": CONTRACT})
    assert names == ["t_contract"] and spark.catalog.tableExists("t_contract")
    path = str(tmp_path / "staged")
    overwrite(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id long, name string, n int"), path)
    truncate_and_load(spark, path, "t_contract", CONTRACT)
    loaded = truncate_and_load(spark, path, "t_contract", CONTRACT)
    assert sorted(tuple(r) for r in loaded.collect()) == [(1, "a", 1), (2, "b", 2)]


def test_truncate_and_load_from_staged_csv(spark, tmp_path):
    path, target = str(tmp_path / "staged_csv"), str(tmp_path / "target_csv")
    spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id long, name string, n int").write.option(
        "header", "true"
    ).csv(path)
    loaded = truncate_and_load(spark, path, target, CONTRACT, "t", source_format="csv", options={"header": "true"})
    assert sorted(tuple(r) for r in loaded.collect()) == [(1, "a", 1), (2, "b", 2)]


def test_csv_columns_are_found_by_header_name(spark, tmp_path):
    from arrivals_mart.schemas import PORT_LOOKUP
    from arrivals_mart.sources.files import read_csv

    moved, short = tmp_path / "moved.csv", tmp_path / "short.csv"
    moved.write_text("note,City,code,state\nx,NEW YORK,NYC,NY\n")
    short.write_text("city,code\nNEW YORK,NYC\n")
    got = read_csv(spark, str(moved), PORT_LOOKUP)
    assert got.columns == ["code", "city", "state"]
    assert [tuple(r) for r in got.collect()] == [("NYC", "NEW YORK", "NY")]
    with pytest.raises(ValueError, match="state"):
        read_csv(spark, str(short), PORT_LOOKUP)


def test_csv_files_with_different_headers_are_rejected(spark, tmp_path):
    from arrivals_mart.schemas import PORT_LOOKUP
    from arrivals_mart.sources.files import read_csv

    folder = tmp_path / "ports"
    folder.mkdir()
    (folder / "a.csv").write_text("code,city,state\nNYC,NEW YORK,NY\n")
    (folder / "b.csv").write_text("city,code,state\nBOSTON,BOS,MA\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(folder), PORT_LOOKUP).collect()


def test_a_failed_load_leaves_the_old_target(spark, tmp_path):
    good, bad, target = (str(tmp_path / d) for d in ("good", "bad", "target"))
    overwrite(spark.createDataFrame([(1, "a", 1)], "id long, name string, n int"), good)
    overwrite(spark.createDataFrame([(2, "b", 2), (None, "c", 3)], "id long, name string, n int"), bad)
    truncate_and_load(spark, good, target, CONTRACT, "t")
    with pytest.raises(Exception, match="t.id is null"):
        truncate_and_load(spark, bad, target, CONTRACT, "t")
    assert [tuple(r) for r in spark.read.parquet(target).collect()] == [(1, "a", 1)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["bad", "good", "target"]
    create_targets(spark, str(tmp_path / "wh"), targets={"t_safe": CONTRACT})
    truncate_and_load(spark, good, "t_safe", CONTRACT)
    with pytest.raises(Exception, match="t_safe.id is null"):
        truncate_and_load(spark, bad, "t_safe", CONTRACT)
    assert [tuple(r) for r in spark.table("t_safe").collect()] == [(1, "a", 1)]


def test_a_table_of_another_shape_is_not_touched(spark, tmp_path):
    staged = str(tmp_path / "staged")
    overwrite(spark.createDataFrame([(1, "new", 1)], "id long, name string, n int"), staged)
    spark.sql(f"CREATE TABLE t_moved (id BIGINT, n INT, name STRING) USING parquet LOCATION '{tmp_path / 'moved'}'")
    spark.sql("INSERT INTO t_moved VALUES (7, 7, 'old')")
    with pytest.raises(ContractError, match="differs from contract"):
        truncate_and_load(spark, staged, "t_moved", CONTRACT)
    assert [tuple(r) for r in spark.table("t_moved").collect()] == [(7, 7, "old")]


def test_truncate_and_load_into_missing_table_fails(spark, tmp_path):
    path = str(tmp_path / "staged_missing")
    overwrite(spark.createDataFrame([(1, "a", 1)], "id long, name string, n int"), path)
    with pytest.raises(ValueError, match="no table 'not_created_yet'"):
        truncate_and_load(spark, path, "not_created_yet", CONTRACT, "t")


def test_rows_are_counted_by_the_write(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (1, "c")], "k long, v string").repartition(3)
    rows, counts = counted(df, "k")
    overwrite(rows, str(tmp_path / "t"))
    assert counts() == {"row_count": 3, "null_keys": 1}
    back = spark.read.parquet(str(tmp_path / "t"))
    got = checked_report(spark, {"t": (back, "k", counts())})
    want = run_checks({"t": (back, "k")})
    assert got.collect() == want.collect() and got.dtypes == want.dtypes
    rows, counts = counted(df.limit(0), "k")
    overwrite(rows, str(tmp_path / "none"))
    empty = spark.read.schema("k long, v string").parquet(str(tmp_path / "none"))
    assert [tuple(r) for r in checked_report(spark, {"t": (empty, "k", counts())}).collect()] == [("t", "k", 0, 0, 0, False)]


@pytest.mark.parametrize("range_hashes,suspects", [(1 << 20, 100_000), (7, 100_000), (50, 3)])
def test_duplicates_by_packed_hashes_equal_plain_counting(spark, monkeypatch, range_hashes, suspects):
    monkeypatch.setattr(quality, "RANGE_HASHES", range_hashes)
    monkeypatch.setattr(quality, "MAX_SUSPECTS", suspects)
    df = spark.range(0, 900, numPartitions=4).select(
        F.when(F.col("id") % 9 != 0, F.col("id") % 171).alias("a"), F.when(F.col("id") % 4 != 0, (F.col("id") % 3).cast("string")).alias("b"))
    want = sorted(map(tuple, df.groupBy("a", "b").count().filter("count > 1").collect()), key=repr)
    assert len(want) > 50 and sorted(map(tuple, duplicate_keys(df, ["a", "b"]).collect()), key=repr) == want
    assert surplus_rows(df, "a") == df.agg(F.count("a") - F.count_distinct("a")).first()[0]
    assert duplicate_keys(df.filter("false"), ["a"]).count() == 0


def test_uniqueness_shuffles_hashes_only(spark):
    df = spark.range(0, 50_000, numPartitions=4).select(F.concat(F.lit("a long key " * 5), F.col("id")).alias("k"))
    plan = quality.suspected_hashes(df, ["k"], 50_000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the arrays; counting in a range needs no other
    assert duplicate_keys(df, ["k"]).count() == 0


def test_the_run_counts_while_it_writes(spark, tmp_path, monkeypatch):
    """Only the key columns are read again, and nothing if uniqueness is not asked for."""
    from arrivals_mart.plans import pipeline

    from .fixtures import frames
    from .test_pipeline_analytics import _stage

    _stage(spark, str(tmp_path / "staging"), frames(spark))
    read = []
    monkeypatch.setattr(quality, "surplus_rows", lambda df, key, rows=None: read.append(key) or 0)
    report = pipeline.run_pipeline(spark, str(tmp_path / "staging"), str(tmp_path / "production"), unique=False, check=False)
    assert read == [] and {r.table_name: r.row_count > 0 for r in report.collect()} == dict.fromkeys(pipeline.TARGETS, True)
    pipeline.run_pipeline(spark, str(tmp_path / "staging"), str(tmp_path / "production"), check=False)
    assert sorted(read) == ["demo_id", "immigration_id", "immigration_id", "temp_id"]


def test_a_changed_row_changes_the_content_of_a_table(spark):
    from arrivals_mart.plans.catalog import content

    schema = T.StructType.fromDDL("k long, v string, d double")
    rows = [(i, f"v{i}", i / 8) for i in range(300)]
    base = content(spark.createDataFrame(rows, schema), schema, "t").collect()
    for changed in ([*rows[:150], (150, "x", 150 / 8), *rows[151:]], rows[:-1], [*rows, rows[7]], [*rows[:5], rows[6], rows[6], *rows[7:]]):
        assert content(spark.createDataFrame(changed, schema), schema, "t").collect() != base
    assert content(spark.createDataFrame(rows[::-1], schema), schema, "t").collect() == base
