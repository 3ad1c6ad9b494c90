import pytest
from pyspark.sql import types as T

from arrivals_mart.sources.reconcile import read_deliveries, reconcile, wider

B, I, L, F_, D, S = T.ByteType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.StringType()


@pytest.mark.parametrize("a,b,want", [
    (I, I, I), (B, L, L), (I, L, L), (F_, D, D), (I, D, D), (L, F_, D), (I, S, S), (T.DateType(), T.TimestampType(), T.TimestampType()),
    (T.DateType(), I, S), (T.DecimalType(10, 2), I, T.DecimalType(12, 2)), (T.DecimalType(10, 2), T.DecimalType(6, 4), T.DecimalType(12, 4)),
    (T.DecimalType(38, 0), T.DecimalType(38, 30), T.DecimalType(38, 0)), (T.BooleanType(), I, S), (T.DecimalType(5, 1), D, S),
])
def test_widening_rules(a, b, want):
    assert wider(a, b) == want and wider(b, a) == want


def test_one_schema_and_what_differs():
    schemas = {
        "jan": T.StructType([T.StructField("id", I), T.StructField("Name", S)]),
        "feb": T.StructType([T.StructField("ID", L), T.StructField("extra", D)]),
        "mar": T.StructType([T.StructField("name", S), T.StructField("id", S)]),
    }
    schema, report = reconcile(schemas)
    assert schema == T.StructType([T.StructField("id", S), T.StructField("Name", S), T.StructField("extra", D)])
    assert sorted(report, key=repr) == sorted([
        ("jan", "id", "retyped", "int", "string"), ("jan", "extra", "missing", None, "double"),
        ("feb", "id", "retyped", "bigint", "string"), ("feb", "Name", "missing", None, "string"), ("feb", "extra", "added", "double", "double"),
        ("mar", "extra", "missing", None, "double"),
    ], key=repr)


def test_deliveries_are_read_as_one(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("jan", "feb")}
    spark.createDataFrame([(1, "x")], "id int, name string").write.parquet(paths["jan"])
    spark.createDataFrame([(2.5, True)], "ID double, flag boolean").write.parquet(paths["feb"])
    (tmp_path / "feb" / "notes.txt").write_text("no parquet")
    rows, report = read_deliveries(spark, paths)
    assert sorted(map(tuple, rows.collect())) == [(1.0, "x", None, "jan"), (2.5, None, True, "feb")]
    assert rows.columns == ["id", "name", "flag", "delivery"] and report.count() == 4
    few, report = read_deliveries(spark, paths, ["NAME"])
    assert few.columns == ["name", "delivery"] and [tuple(r) for r in report.collect()] == [("feb", "name", "missing", None, "string")]
    assert "ReadSchema: struct<name:string>" in few._jdf.queryExecution().toString()
