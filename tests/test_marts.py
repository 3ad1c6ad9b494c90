import datetime as dt

from arrivals_mart.plans.marts import (
    build_demographics_dim,
    build_fact,
    build_person_dim,
    build_temperature_dim,
)
from arrivals_mart.schemas import DIM_DEMOGRAPHICS, DIM_IMMIGRANT, DIM_TEMPERATURE, FACT_IMMIGRATION

from .fixtures import frames

D = dt.date


def test_fact_decodes_joins_and_drops(spark):
    f = frames(spark)
    fact = build_fact(f["arrivals"], f["ports"])
    assert [x.name for x in fact.schema.fields] == [x.name for x in FACT_IMMIGRATION.fields]
    got = {r.immigration_id: r.asDict() for r in fact.collect()}
    assert sorted(got) == ["10", "11", "6", "7"]  # unknown port 8 and missing arrival date 9 dropped
    assert got["6"]["transport_mode"] == "Air"
    assert got["6"]["arrival_state"] == "CA"  # own address wins
    assert got["6"]["arrival_date"] == D(2016, 4, 1)
    assert got["6"]["departure_date"] == D(2016, 4, 6)
    assert got["6"]["travel_purpose"] == "Pleasure"
    assert got["7"]["arrival_city"] == "NEW YORK"  # lower-case port code matched
    assert got["7"]["arrival_state"] == "NY"  # falls back to the port's state
    assert got["7"]["departure_date"] is None
    assert (got["10"]["transport_mode"], got["10"]["travel_purpose"]) == (None, None)
    assert got["11"]["arrival_city"] == "LOS ANGELES"  # mixed case on both sides
    assert got["11"]["imm_year"] == 2016 and got["11"]["imm_month"] == 4


def test_fact_plan_broadcasts_lookup_and_has_inner_join(spark):
    f = frames(spark)
    plan = build_fact(f["arrivals"], f["ports"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert "LeftOuter" not in plan  # null-rejected outer join became inner
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan  # one map stage


def test_person_dim_filters_and_role_playing_lookups(spark):
    f = frames(spark)
    person = build_person_dim(f["arrivals"], f["countries"])
    assert [x.name for x in person.schema.fields] == [x.name for x in DIM_IMMIGRANT.fields]
    got = {r.immigration_id: tuple(r)[1:] for r in person.collect()}
    assert got == {
        "6": ("PUMICE ROCK", "PUMICE ROCK", 37, 1979, "M"),  # padded code ' 9002' matches 9002
        "7": ("CORALIA", "PUMICE ROCK", 37, 1986, "F"),  # 37.7 truncates
        "8": (None, "PUMICE ROCK", 20, 1986, "M"),  # unknown citizenship stays null
    }


def test_temperature_dim_averages_filters_and_numbers(spark):
    dim = build_temperature_dim(frames(spark)["temperature"])
    assert [x.name for x in dim.schema.fields] == [x.name for x in DIM_TEMPERATURE.fields]
    got = sorted(tuple(r) for r in dim.collect())
    assert got == [
        (1, D(1980, 1, 1), "Austin", "United States", 15.0, 2.0),
        (2, D(1980, 1, 1), "Boston", "United States", None, None),
        (3, D(1980, 2, 1), "Austin", "United States", 8.0, 0.5),
    ]


def test_demographics_dim_types_and_keys(spark):
    dim = build_demographics_dim(frames(spark)["demographics"])
    assert [x.name for x in dim.schema.fields] == [x.name for x in DIM_DEMOGRAPHICS.fields]
    got = sorted(tuple(r) for r in dim.collect())
    assert got == [
        (1, "Alpha", "AK", "Black", 33.5, 12, None, 300, None, 7, 2.5),
        (2, "Alpha", "AL", "White", 33.5, 5, 6, 200, 1, 7, 2.5),
        (3, "Zeta", "TX", "Asian", 33.5, 12, None, 100, None, 7, 2.5),
    ]


def test_person_dim_filter_reaches_parquet_scan(spark, tmp_path):
    f = frames(spark)
    path = str(tmp_path / "arrivals")
    f["arrivals"].write.parquet(path)
    arrivals = spark.read.parquet(path)
    plan = build_person_dim(arrivals, f["countries"])._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: ")[1].split(", ReadSchema")[0]
    assert "In(gender, [F,M])" in pushed and "IsNotNull(i94bir)" in pushed
    # only the six arrival columns the dimension uses are read
    read_schema = plan[plan.index("ReadSchema: struct<") + len("ReadSchema: struct<") :].split(">")[0]
    assert read_schema.count(":") == 6 and "i94port" not in read_schema


def test_fact_keeps_plus_drops_equal_input(spark):
    f = frames(spark)
    fact = build_fact(f["arrivals"], f["ports"])
    known_ports = [r.code.lower() for r in f["ports"].collect()]
    from pyspark.sql import functions as F

    dropped = f["arrivals"].filter(~F.lower("i94port").isin(known_ports) | F.col("arrdate").isNull())
    assert fact.count() + dropped.count() == f["arrivals"].count()
