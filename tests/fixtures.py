"""Hand-written raw rows with the edge values listed in FIXTURES.md (invented values)."""

from arrivals_mart.schemas import ARRIVALS, COUNTRY_LOOKUP, DEMOGRAPHICS_RAW, PORT_LOOKUP, TEMPERATURE_RAW


def arrival(cicid, port, arrdate=20545.0, mode=1.0, addr=None, dep=None, bir=30.0, visa=2.0,
            gender="M", cit=9002.0, res=9002.0, biryear=1986.0):
    return (cicid, 2016.0, 4.0, cit, res, port, arrdate, mode, addr, dep, bir, visa, biryear, gender,
            "AA", "B2", "SEL")


ARRIVAL_ROWS = [
    arrival(6.0, "QU0", mode=1.0, addr="CA", dep=20550.0, bir=37.0, visa=2.0, gender="M", biryear=1979.0),
    arrival(7.0, "nyc", arrdate=20546.0, mode=2.0, bir=37.7, visa=1.0, gender="F", cit=9001.0),
    arrival(8.0, "QQQ", gender="M", bir=20.0, cit=12345.0),
    arrival(9.0, "NYC", arrdate=None, gender="F", bir=None),
    arrival(10.0, "NYC", mode=5.0, visa=4.0, gender="X", bir=None),
    arrival(11.0, "Lax", mode=None, visa=None, gender=None, cit=12345.0, res=None),
]

PORT_ROWS = [("QU0", "OPEN SEA", None), ("NYC", "NEW YORK", "NY"), ("lax", "LOS ANGELES", "CA")]
COUNTRY_ROWS = [(" 9002", "PUMICE ROCK"), ("9001", "CORALIA"), ("abc", "JUNK")]


def temp(dt, t, u, city, country="United States"):
    return (dt, t, u, city, country, "30.26N", "97.74W")


TEMPERATURE_ROWS = [
    temp("1980-01-01", "10.0", "1.0", "Austin"),
    temp("1980-01-01", "20.0", "3.0", "Austin"),
    temp("1980-01-01", "", "", "Boston"),
    temp("1979-12-01", "5.0", "1.0", "Austin"),
    temp("bad", "5.0", "1.0", "Austin"),
    temp("1980-02-01", "7.0", "0.5", "Austin", "Canada"),
    temp("1980-02-01", "8.0", "0.5", "Austin"),
]


def demo(city, state_code, race, total, male="12.0", female="", veterans="x"):
    return (city, "State", "33.5", male, female, total, veterans, "7", "2.5", state_code, race, "3")


DEMOGRAPHICS_ROWS = [
    demo("Zeta", "TX", "Asian", "100"),
    demo("Alpha", "AL", "White", "200", male="5", female="6", veterans="1"),
    demo("Alpha", "AK", "Black", "300"),
]


def frames(spark):
    return {
        "arrivals": spark.createDataFrame(ARRIVAL_ROWS, ARRIVALS),
        "ports": spark.createDataFrame(PORT_ROWS, PORT_LOOKUP),
        "countries": spark.createDataFrame(COUNTRY_ROWS, COUNTRY_LOOKUP),
        "temperature": spark.createDataFrame(TEMPERATURE_ROWS, TEMPERATURE_RAW),
        "demographics": spark.createDataFrame(DEMOGRAPHICS_ROWS, DEMOGRAPHICS_RAW),
    }
