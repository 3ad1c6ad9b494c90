import datetime as dt

import pytest
from pyspark.sql import functions as F

from arrivals_mart.functions import (
    TRANSPORT_MODES,
    date_parts,
    decode,
    epoch_ms,
    from_day_number,
    from_epoch_ms,
    hash_key,
    int_key,
    to_day_number,
    tolerant_date,
    tolerant_double,
    tolerant_int,
)


def test_tolerant_casts_turn_junk_into_null(spark):
    df = spark.createDataFrame(
        [(" 12",), ("12.0",), ("12.7",), ("-12.7",), ("",), ("abc",), ("1e20",), (None,)], "x string"
    )
    got = [tuple(r) for r in df.select("x", tolerant_int("x"), tolerant_double("x")).collect()]
    assert got == [
        (" 12", 12, 12.0),
        ("12.0", 12, 12.0),
        ("12.7", 12, 12.7),
        ("-12.7", -12, -12.7),
        ("", None, None),
        ("abc", None, None),
        ("1e20", None, 1e20),
        (None, None, None),
    ]


def test_tolerant_date(spark):
    df = spark.createDataFrame([("1980-01-01",), ("2001-13-05",), ("not a date",), ("",)], "x string")
    assert [r[0] for r in df.select(tolerant_date("x")).collect()] == [dt.date(1980, 1, 1), None, None, None]


def test_int_key_drops_fraction_and_keeps_large_keys(spark):
    df = spark.createDataFrame([(6.0,), (6.9,), (None,), (5e9,)], "x double")
    assert [r[0] for r in df.select(int_key("x")).collect()] == ["6", "6", None, "5000000000"]


def test_day_numbers(spark):
    df = spark.createDataFrame([(20545.0,), (None,), (0.0,), (20545.9,)], "d double")
    got = [r[0] for r in df.select(from_day_number("d")).collect()]
    assert got == [dt.date(2016, 4, 1), None, dt.date(1960, 1, 1), dt.date(2016, 4, 1)]
    back = spark.createDataFrame([(dt.date(2016, 4, 1),)], "d date").select(to_day_number("d")).first()[0]
    assert back == 20545


def test_epoch_ms_is_truncated_to_seconds(spark):
    df = spark.createDataFrame([(1999,), (1704067207179,), (-1500,), (None,)], "ms long")
    got = [r[0] for r in df.select(from_epoch_ms("ms")).collect()]
    assert got == [
        dt.datetime(1970, 1, 1, 0, 0, 1),
        dt.datetime(2024, 1, 1, 0, 0, 7),
        dt.datetime(1969, 12, 31, 23, 59, 59),
        None,
    ]
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),)], "t timestamp_ntz")
    assert ts.select(epoch_ms("t")).first()[0] == 1704067207179


def test_date_parts_weekday_starts_sunday_and_week_is_iso(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 13, 5, 0),)], "t timestamp_ntz")
    parts = date_parts(F.col("t"))
    r = df.select(*[c.alias(n) for n, c in parts.items()]).first().asDict()
    assert r == {"hour": 13, "day": 7, "week": 1, "month": 1, "year": 2024, "weekday": 0}


def test_decode_numeric_codes(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (9.0,), (5.0,), (None,)], "m double")
    got = [r[0] for r in df.select(decode("m", TRANSPORT_MODES)).collect()]
    assert got == ["Air", "Sea", "Land", "Not reported", None, None]


def test_hash_key_is_md5_of_text_and_null_propagates(spark):
    df = spark.createDataFrame([(8, "click"), (None, "view")], "u long, e string")
    got = [r[0] for r in df.select(hash_key("u", "e")).collect()]
    assert got == ["d616c19dd455c4e1e88f40f47c471170", None]


def test_register_view_redefined_from_itself(spark):
    from arrivals_mart.sources.files import register

    register(spark.createDataFrame([(1,), (2,)], "a int"), "stg_self")
    register(spark.sql("SELECT a + 10 AS a FROM stg_self"), "stg_self")
    assert sorted(r.a for r in spark.table("stg_self").collect()) == [11, 12]


def test_scale_defaults_keep_submitted_values(spark):
    from arrivals_mart.session import SCALE_DEFAULTS, apply_scale_defaults

    submitted = spark.sparkContext.getConf()
    applied = apply_scale_defaults(spark)
    for key in SCALE_DEFAULTS:
        if submitted.contains(key):
            assert key not in applied  # a value given at submit time is never overridden
        else:
            assert spark.conf.get(key) == SCALE_DEFAULTS[key]
    assert "spark.sql.adaptive.enabled" not in applied  # the test session sets it explicitly


def test_month_helpers_for_range_frames(spark):
    from arrivals_mart.functions import month_index, month_start

    df = spark.createDataFrame(
        [(dt.date(1999, 12, 31),), (dt.date(2000, 1, 15),), (dt.date(2000, 3, 1),)], "d date"
    )
    got = [tuple(r) for r in df.select(month_start("d"), month_index("d")).collect()]
    assert got == [(dt.date(1999, 12, 1), 23999), (dt.date(2000, 1, 1), 24000), (dt.date(2000, 3, 1), 24002)]


def test_decode_default_for_unknown_codes(spark):
    df = spark.createDataFrame([(1.0,), (4.0,)], "v double")
    assert [r[0] for r in df.select(decode("v", {1: "one"}, default="other")).collect()] == ["one", "other"]


def test_integral_keys_keep_their_last_digit(spark):
    df = spark.createDataFrame([(9007199254740993, "9007199254740993", 7.9)], "a long, b string, c double")
    from arrivals_mart.functions.casts import int_key

    assert tuple(df.select(int_key("a"), int_key("b"), int_key("c")).first()) == ("9007199254740993", "9007199254740993", "7")


def test_text_with_suffix_or_exponent_is_no_integer(spark):
    from arrivals_mart.functions.casts import tolerant_double, tolerant_int, tolerant_long

    texts = ["64D", "64f", "1e3", " 5 ", "12.0", "-12.7", "+3", ".5", "", "abc", "99999999999"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [tuple(r) for r in df.select(tolerant_int("v"), tolerant_long("v")).collect()]
    assert got == [(None, None), (None, None), (None, None), (5, 5), (12, 12), (-12, -12), (3, 3), (0, 0), (None, None),
                   (None, None), (None, 99999999999)]
    assert df.select(tolerant_double("v")).collect()[2][0] == 1000.0


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from arrivals_mart.session import checkpoint_root

    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    class Session:
        sparkContext = None

        def __init__(self, **conf):
            self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session(spark_master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        checkpoint_root(Session(spark_master="local-cluster[2,1,1024]"))
    session = Session(spark_master="spark://host:7077")
    session.conf["spark.checkpoint.dir"] = "hdfs://name/shared/"
    assert checkpoint_root(session) == "hdfs://name/shared"
    assert checkpoint_root(Session(spark_master="local[4]")).startswith("file:///")


def test_clear_scratch_removes_this_application_only(spark, tmp_path):
    import os

    from arrivals_mart.session import clear_scratch, scratch_path, stored

    df = stored(spark.range(3).toDF("a"), "x")
    assert df.count() == 3
    path = scratch_path(spark, "y").removeprefix("file://")
    root = os.path.dirname(path)
    assert os.path.isdir(root)
    clear_scratch(spark)
    assert not os.path.exists(root)
