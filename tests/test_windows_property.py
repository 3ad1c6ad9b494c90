import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from arrivals_mart.operators.windows import trailing_average
from arrivals_mart.plans import analytics

_series = st.dictionaries(
    st.tuples(st.sampled_from(["x", "y"]), st.integers(0, 30)),  # (city, month number)
    st.one_of(st.none(), st.integers(-20, 40).map(float)),
    max_size=25,
)


def _month(n):
    return dt.date(2000 + n // 12, n % 12 + 1, 1)


@settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(series=_series)
def test_trailing_average_matches_brute_force(spark, series):
    rows = [(c, _month(m), v) for (c, m), v in series.items()]
    df = spark.createDataFrame(rows, "city string, month date, v double")
    got = {(r.city, r.month): r.t for r in trailing_average(df, ["city"], "month", "v", 3, "t").collect()}
    for (c, m), _ in series.items():
        window = [v for (c2, m2), v in series.items() if c2 == c and m - 2 <= m2 <= m and v is not None]
        want = sum(window) / len(window) if window else None
        have = got[(c, _month(m))]
        assert (have is None and want is None) or abs(have - want) < 1e-9


@settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(temps=_series, arrivals=st.sets(st.tuples(st.sampled_from(["x", "y"]), st.integers(0, 30)), max_size=15))
def test_as_of_matches_brute_force(spark, temps, arrivals):
    t = spark.createDataFrame(
        [(c, _month(m), v) for (c, m), v in temps.items()], "city string, month date, trailing_avg_temp double"
    )
    a = spark.createDataFrame([(c, _month(m), 1) for c, m in arrivals], "city string, month date, arrivals bigint")
    got = {(r.city, r.month): (r.temp_month, r.trailing_avg_temp) for r in analytics._as_of_latest(a, t).collect()}
    assert len(got) == len(arrivals)
    for c, m in arrivals:
        earlier = [m2 for (c2, m2) in temps if c2 == c and m2 <= m]
        want = (_month(max(earlier)), temps[(c, max(earlier))]) if earlier else (None, None)
        assert got[(c, _month(m))] == want
