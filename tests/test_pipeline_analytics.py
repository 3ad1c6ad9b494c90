import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from arrivals_mart.plans import analytics
from arrivals_mart.plans.marts import build_demographics_dim, build_fact, build_temperature_dim
from arrivals_mart.plans.pipeline import StagingLayout, run_pipeline

from .fixtures import frames


def _stage(spark, root, f, layout=StagingLayout()):
    # arrival files sit one folder below the arrivals path, as delivered
    f["arrivals"].write.parquet(os.path.join(root, layout.arrivals, "delivery-0001"))
    f["ports"].write.option("header", "true").csv(os.path.join(root, layout.ports))
    f["countries"].write.option("header", "true").csv(os.path.join(root, layout.countries))
    f["temperature"].write.option("header", "true").csv(os.path.join(root, layout.temperature))
    f["demographics"].write.option("header", "true").option("sep", ";").csv(os.path.join(root, layout.demographics))


def test_pipeline_end_to_end(spark, tmp_path):
    staging, prod, wh = (str(tmp_path / d) for d in ("staging", "production", "warehouse"))
    _stage(spark, staging, frames(spark))
    report = run_pipeline(spark, staging, prod, warehouse=wh)
    got = {r.table_name: (r.row_count, r.passed) for r in report.collect()}
    assert got == {
        "fact_immigration": (4, True),
        "dim_immigrant": (3, True),
        "dim_temperature": (3, True),
        "dim_demographics": (3, True),
    }
    assert spark.read.parquet(os.path.join(wh, "dim_demographics")).count() == 3


def test_pipeline_raises_on_empty_table(spark, tmp_path):
    f = frames(spark)
    f["temperature"] = f["temperature"].withColumn("Country", F.lit("Canada"))
    staging = str(tmp_path / "staging")
    _stage(spark, staging, f)
    with pytest.raises(ValueError, match="dim_temperature contained 0 rows"):
        run_pipeline(spark, staging, str(tmp_path / "prod"))


def test_top_city_arrivals_share_and_ties(spark):
    f = frames(spark)
    fact = build_fact(f["arrivals"], f["ports"])
    demo = spark.createDataFrame(
        [("New York", "ny", "R1", 50), ("New York", "ny", "R2", 50), ("los angeles", "CA", "R1", 40),
         ("Nowhere", "ZZ", "R1", None), ("Tie", "AA", "R1", 40)],
        "city string, state_code string, race string, total_population int",
    )
    top = analytics.top_cities(demo, 2)
    assert [tuple(r) for r in top.collect()] == [("New York", "ny", 50), ("Tie", "AA", 40)]  # T before l
    got = [tuple(r) for r in analytics.top_city_arrivals(fact, demo, 3).collect()]
    assert got == [("NEW YORK", 50, 2), ("LOS ANGELES", 40, 1)]
    share = analytics.top_city_share(fact, demo, 3).first()
    assert (share.total_arrivals, share.covered_arrivals, share.share_pct) == (4, 3, 75.0)


def test_trailing_average_does_not_bridge_gaps(spark):
    rows = [("2000-01-01", 1.0), ("2000-02-01", 2.0), ("2000-03-01", 3.0), ("2000-07-01", 10.0), ("2000-08-01", 20.0)]
    raw = spark.createDataFrame(
        [(d, str(t), "0.1", "Austin", "United States", "", "") for d, t in rows],
        "dt string, AverageTemperature string, AverageTemperatureUncertainty string, City string, "
        "Country string, Latitude string, Longitude string",
    )
    out = analytics.trailing_temperatures(build_temperature_dim(raw))
    got = {r.month: r.trailing_avg_temp for r in out.collect()}
    assert got == {
        dt.date(2000, 1, 1): 1.0,
        dt.date(2000, 2, 1): 1.5,
        dt.date(2000, 3, 1): 2.0,
        dt.date(2000, 7, 1): 10.0,
        dt.date(2000, 8, 1): 15.0,
    }


def test_demographics_top_k_is_deterministic(spark):
    dim = build_demographics_dim(frames(spark)["demographics"])
    assert [r.city for r in analytics.top_cities(dim, 2).collect()] == ["Alpha", "Alpha"]


def test_as_of_takes_latest_earlier_temperature_month(spark):
    arrivals = spark.createDataFrame(
        [("austin", dt.date(2000, 2, 1), 5), ("austin", dt.date(2000, 5, 1), 7), ("austin", dt.date(1999, 1, 1), 1),
         ("boston", dt.date(2000, 5, 1), 3)],
        "city string, month date, arrivals bigint",
    )
    temps = spark.createDataFrame(
        [("austin", dt.date(2000, 2, 1), 1.5), ("austin", dt.date(2000, 3, 1), None), ("boston", dt.date(2000, 6, 1), 9.0)],
        "city string, month date, trailing_avg_temp double",
    )
    got = sorted(tuple(r) for r in analytics._as_of_latest(arrivals, temps).collect())
    assert got == [
        ("austin", dt.date(1999, 1, 1), 1, None, None),
        ("austin", dt.date(2000, 2, 1), 5, 1.5, dt.date(2000, 2, 1)),
        ("austin", dt.date(2000, 5, 1), 7, None, dt.date(2000, 3, 1)),  # latest month even if its value is null
        ("boston", dt.date(2000, 5, 1), 3, None, None),
    ]


def test_command_line_run(spark, tmp_path, capsys):
    from arrivals_mart.__main__ import main

    staging = str(tmp_path / "staging")
    _stage(spark, staging, frames(spark))
    assert main(["run", "--staging", staging, "--production", str(tmp_path / "prod")], spark=spark) == 0
    out = capsys.readouterr().out
    assert "fact_immigration: 4 rows" in out and "dim_demographics: 3 rows" in out


def test_command_line_run_from_config(spark, tmp_path, capsys):
    from arrivals_mart.__main__ import main

    staging = str(tmp_path / "staging")
    layout = StagingLayout(arrivals="imm", ports="ports.csv", countries="countries.csv", temperature="t", demographics="d")
    _stage(spark, staging, frames(spark), layout)
    cfg = tmp_path / "run.cfg"
    cfg.write_text(
        "[S3]\nSTAGING_DATA=%s\nPRODUCTION_DATA=%s\n\n[DATA]\nIMMIGRATION=imm\nPORT_MAPPING=ports.csv\n"
        "COUNTRY_MAPPING=countries.csv\nTEMPERATURE=t\nDEMOGRAPHICS=d\n" % (staging, tmp_path / "prod")
    )
    assert main(["run", "--config", str(cfg)], spark=spark) == 0
    assert "dim_temperature: 3 rows" in capsys.readouterr().out


def test_share_counts_a_fact_once_however_often_its_city_is_listed(spark):
    fact = spark.createDataFrame(
        [("1", "Springfield", "IL"), ("2", "SPRINGFIELD", "il"), ("3", "Elsewhere", "IL")],
        "immigration_id string, arrival_city string, arrival_state string",
    )
    demo = spark.createDataFrame(
        [("Springfield", "IL", "R1", 100), ("Springfield", "IL", "R2", 101), ("springfield", "IL", "R3", 101)],
        "city string, state_code string, race string, total_population int",
    )
    share = analytics.top_city_share(fact, demo, 10).first()
    assert (share.total_arrivals, share.covered_arrivals, share.share_pct) == (3, 2, 66.6667)
    assert share.covered_arrivals <= share.total_arrivals == fact.count()
    got = sorted(tuple(r) for r in analytics.top_city_arrivals(fact, demo, 10).collect())
    # one row per spelling of the fact and total; two spellings of one total count a fact once
    assert got == [("SPRINGFIELD", 100, 1), ("SPRINGFIELD", 101, 1), ("Springfield", 100, 1), ("Springfield", 101, 1)]


def test_null_record_keys_are_all_counted(spark, tmp_path):
    from arrivals_mart.schemas import ARRIVALS

    from .fixtures import ARRIVAL_ROWS, arrival

    f = frames(spark)
    f["arrivals"] = spark.createDataFrame(ARRIVAL_ROWS + [arrival(None, "NYC")] * 2, ARRIVALS)
    staging = str(tmp_path / "staging")
    _stage(spark, staging, f)
    with pytest.raises(ValueError, match="fact_immigration.immigration_id is null in 2 rows.*dim_immigrant"):
        run_pipeline(spark, staging, str(tmp_path / "prod"))
    report = run_pipeline(spark, staging, str(tmp_path / "prod2"), check=False, unique=False)
    got = {r.table_name: (r.null_keys, r.duplicate_keys, r.passed) for r in report.collect()}
    assert got["fact_immigration"] == (2, 0, False) and got["dim_temperature"] == (0, 0, True)


def test_stray_files_of_a_delivery_are_left_out(spark, tmp_path):
    staging = str(tmp_path / "staging")
    _stage(spark, staging, frames(spark))
    with open(os.path.join(staging, "immigration", "notes.txt"), "w") as f:
        f.write("not parquet")
    report = run_pipeline(spark, staging, str(tmp_path / "prod"))
    assert {r.table_name: r.row_count for r in report.collect()}["fact_immigration"] == 4


def test_command_line_lookups_then_run(spark, tmp_path, capsys):
    """Label dictionary -> lookup CSVs -> whole run, as the command line does it."""
    from arrivals_mart.__main__ import main
    from arrivals_mart.sources.labels import COUNTRY_BLOCK, PORT_BLOCK, STATE_BLOCK

    text = "\r\n".join(
        [
            f"  value {COUNTRY_BLOCK}",
            "   9002 =  'PUMICE ROCK'",
            "   9001 =  'CORALIA'",
            f"  value {PORT_BLOCK}",
            "   'QU0'\t=\t'OPEN SEA  '",
            "   'NYC'\t=\t'NEW YORK, NY'",
            "   'LAX'\t=\t'LOS ANGELES, CA #ARPT'",
            ";",
            f"value {STATE_BLOCK}",
            "\t'CA'='CALIFORNIA'",
            "\t'NY'='NEW YORK' ;",
            "",
        ]
    )
    labels = tmp_path / "labels.txt"
    labels.write_bytes(text.encode("latin-1"))
    staging = str(tmp_path / "staging")
    f = frames(spark)
    f["arrivals"].write.parquet(os.path.join(staging, "immigration", "delivery-0001"))
    f["temperature"].write.option("header", "true").csv(os.path.join(staging, "temperature"))
    f["demographics"].write.option("header", "true").option("sep", ";").csv(os.path.join(staging, "demographics"))
    assert main(["lookups", "--labels", str(labels), "--staging", staging], spark=spark) == 0
    assert main(["run", "--staging", staging, "--production", str(tmp_path / "prod")], spark=spark) == 0
    out = capsys.readouterr().out
    assert "fact_immigration: 4 rows" in out and "dim_immigrant: 3 rows" in out
    fact = spark.read.parquet(str(tmp_path / "prod" / "fact_immigration"))
    got = {r.immigration_id: (r.arrival_city, r.arrival_state) for r in fact.collect()}
    assert got["7"] == ("NEW YORK", "NY") and got["11"] == ("LOS ANGELES", "CA") and got["6"] == ("OPEN SEA", "CA")


def test_bucketed_warehouse_star_join_without_shuffle(spark, tmp_path):
    from arrivals_mart.plans.marts import build_person_dim

    staging = str(tmp_path / "staging")
    _stage(spark, staging, frames(spark))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS wh_bucketed LOCATION '{tmp_path / 'wh'}'")
    report = run_pipeline(spark, staging, str(tmp_path / "prod"), warehouse="wh_bucketed", buckets=4)
    assert all(r.passed for r in report.collect())
    fact, person = spark.table("wh_bucketed.fact_immigration"), spark.table("wh_bucketed.dim_immigrant")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = analytics.star_join(fact, person, scatter_null_keys=False)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
        f = frames(spark)
        expected = analytics.star_join(build_fact(f["arrivals"], f["ports"]), build_person_dim(f["arrivals"], f["countries"]))
        assert sorted(map(tuple, joined.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_command_line_check_reports_and_fails(spark, tmp_path, capsys):
    from arrivals_mart.__main__ import main

    staging, prod = str(tmp_path / "staging"), str(tmp_path / "prod")
    _stage(spark, staging, frames(spark))
    main(["run", "--staging", staging, "--production", prod], spark=spark)
    capsys.readouterr()
    assert main(["check", "--tables", prod], spark=spark) == 0
    assert "dim_immigrant: 3 rows" in capsys.readouterr().out
    # a duplicated key in a loaded table fails the check
    dup = spark.read.parquet(os.path.join(prod, "dim_demographics"))
    dup.unionByName(dup).write.mode("overwrite").parquet(os.path.join(str(tmp_path), "dup"))
    spark.read.parquet(os.path.join(str(tmp_path), "dup")).write.mode("overwrite").parquet(os.path.join(prod, "dim_demographics"))
    with pytest.raises(ValueError, match="dim_demographics.demo_id repeats"):
        main(["check", "--tables", prod], spark=spark)


def test_config_without_data_section_uses_default_layout(tmp_path):
    from arrivals_mart.plans.pipeline import layout_from_config

    cfg = tmp_path / "roots.cfg"
    cfg.write_text("[S3]\nSTAGING_DATA=s3a://bucket/staging\nPRODUCTION_DATA=s3a://bucket/production\n")
    staging, production, layout = layout_from_config(str(cfg))
    assert (staging, production, layout) == ("s3a://bucket/staging", "s3a://bucket/production", StagingLayout())
    with pytest.raises(FileNotFoundError):
        layout_from_config(str(tmp_path / "missing.cfg"))


def test_only_the_months_that_the_temperatures_select_are_read(spark, tmp_path):
    from arrivals_mart.operators.sinks import overwrite_partitions
    from arrivals_mart.plans.analytics import arrivals_in_warm_months

    fact = spark.createDataFrame(
        [(str(i), 2016, 1 + i % 12, "here") for i in range(120)], "immigration_id string, imm_year int, imm_month int, arrival_city string")
    path = str(tmp_path / "fact")
    overwrite_partitions(fact, path, ["imm_year", "imm_month"])
    temps = spark.createDataFrame([("2016-02-01", 29.0), ("2016-07-01", 30.0), ("2016-07-01", 31.0), ("2016-08-01", 20.0)], "d string, avg_temp double")
    temps = temps.select(temps.d.cast("date").alias("temp_report_month"), "avg_temp")
    temps.write.parquet(str(tmp_path / "temps"))
    out = arrivals_in_warm_months(spark.read.parquet(path), spark.read.parquet(str(tmp_path / "temps")), 28.0)
    assert sorted(map(tuple, out.collect())) == [(2016, 2, 10), (2016, 7, 10)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression" in plan


def test_codes_of_a_dictionary_block_decode_a_column(spark, tmp_path):
    import pytest

    from arrivals_mart.functions.codes import decode
    from arrivals_mart.sources.labels import MODE_BLOCK, block_codes, label_dictionary

    (tmp_path / "d.txt").write_text(f"value {MODE_BLOCK}\n 1 = 'By air'\n 2 = 'By sea'\n 9 = 'No Mode Code' ;\nvalue $x 'A' = 'a' '1' = 'one'")
    labels = label_dictionary(spark, str(tmp_path / "d.txt"))
    codes = block_codes(labels, MODE_BLOCK)
    assert codes == {1: "By air", 2: "By sea", 9: "No Mode Code"} and block_codes(labels, MODE_BLOCK, valid_only=True) == {1: "By air", 2: "By sea"}
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "m double")
    assert [r[0] for r in df.select(decode("m", codes)).collect()] == ["By air", "By sea", None, None]
    assert block_codes(labels, "$x") == {"A": "a", "1": "one"} and block_codes(labels, "none") == {}
    with pytest.raises(ValueError, match="more than 2 codes"):
        block_codes(labels, MODE_BLOCK, max_codes=2)
