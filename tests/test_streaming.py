import os

from arrivals_mart.plans.marts import build_fact
from arrivals_mart.streaming.incremental import incremental_fact_load

from .fixtures import frames


def test_incremental_fact_loads_only_new_files(spark, tmp_path):
    f = frames(spark)
    arrivals_dir, target, ckpt = (str(tmp_path / d) for d in ("arrivals", "fact", "ckpt"))
    first = f["arrivals"].filter("cicid < 8")
    rest = f["arrivals"].filter("cicid >= 8")
    first.write.parquet(arrivals_dir + "/delivery=2016-04")
    assert incremental_fact_load(spark, arrivals_dir, f["ports"], target, ckpt) == 1
    assert spark.read.parquet(target).count() == 2
    assert incremental_fact_load(spark, arrivals_dir, f["ports"], target, ckpt) == 0  # nothing new
    rest.write.parquet(arrivals_dir + "/delivery=2016-05")  # next month's delivery, a new sub-folder
    assert incremental_fact_load(spark, arrivals_dir, f["ports"], target, ckpt) == 1
    loaded = spark.read.parquet(target)
    assert {"load_batch=0", "load_batch=1"} <= set(os.listdir(target))
    expected = sorted(tuple(r) for r in build_fact(f["arrivals"], f["ports"]).collect())
    assert sorted(tuple(r) for r in loaded.drop("load_batch").collect()) == expected


def test_command_line_incremental(spark, tmp_path, capsys):
    from arrivals_mart.__main__ import main

    f = frames(spark)
    arrivals, ports = str(tmp_path / "arrivals"), str(tmp_path / "ports")
    f["arrivals"].write.parquet(arrivals + "/delivery=2016-04")
    f["ports"].write.option("header", "true").csv(ports)
    args = ["incremental", "--arrivals", arrivals, "--ports", ports, "--target", str(tmp_path / "fact"),
            "--checkpoint", str(tmp_path / "ckpt")]
    assert main(args, spark=spark) == 0
    assert "1 micro-batches loaded" in capsys.readouterr().out
    assert main(args, spark=spark) == 0  # nothing new on a second run
    assert "0 micro-batches loaded" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "fact")).count() == 4


def test_stray_files_are_passed_over_and_null_keys_counted(spark, tmp_path):
    from pyspark.sql import functions as F

    f = frames(spark)
    arrivals_dir, target, ckpt = (str(tmp_path / d) for d in ("arrivals", "fact", "ckpt"))
    arrivals = f["arrivals"].withColumn("cicid", F.when(F.col("cicid") >= 8, F.col("cicid")))
    arrivals.write.parquet(arrivals_dir + "/delivery=2016-04")
    (tmp_path / "arrivals" / "notes.txt").write_text("not parquet")
    (tmp_path / "arrivals" / "delivery=2016-04" / "readme").write_text("neither")
    report = []
    assert incremental_fact_load(spark, arrivals_dir, f["ports"], target, ckpt, report=report) == 1
    loaded = spark.read.parquet(target)
    nulls = loaded.filter("immigration_id IS NULL").count()
    assert nulls > 0 and report == [{"batch": 0, "row_count": loaded.count(), "null_keys": nulls}]
