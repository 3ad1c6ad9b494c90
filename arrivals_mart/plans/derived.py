"""Mart inputs derived from the driver's test tables.

The arrival records, code lookups, temperature readings, demographics and
listening log are shaped out of ``orders``, ``customer``, ``lineitem``,
``part``, ``supplier``, ``nation`` and ``region`` so that every mart build
runs over data that grows with the scale factor. The rules are plain
expressions on the source columns (the same rules are written in SQL in
:mod:`arrivals_mart.plans.oracle`), and they produce the raw-data edge cases
the builds must handle: junk numbers, empty strings, unknown and mixed-case
codes, null dates, fractional ages, non-numeric counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals_mart.functions.dates import epoch_ms, to_day_number
from arrivals_mart.operators.lookups import sized_broadcast
from arrivals_mart.sources.files import read_table

# nation and region have a fixed number of rows at every scale factor (25 and 5),
# so they are broadcast without a counting job.
FIXED_SIZE = None


def _s(c):
    return c.cast("string")


def _d(c):
    return c.cast("double")


def arrivals(orders: DataFrame) -> DataFrame:
    """Arrival records (double codes as in the raw parquet) from orders."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    day = _d(to_day_number(F.col("o_orderdate")))
    arr = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(day)
    mode = (
        F.when(k % 6 == 0, 1.0).when(k % 6 == 1, 2.0).when(k % 6 == 2, 3.0)
        .when(k % 6 == 3, 9.0).when(k % 6 == 4, 5.0)
    )
    age = F.when(c % 11 == 0, F.lit(None)).otherwise(_d(c % 90) + 0.5)
    return orders.select(
        _d(k).alias("cicid"),
        _d(F.year("o_orderdate")).alias("i94yr"),
        _d(F.month("o_orderdate")).alias("i94mon"),
        _d(c % 30).alias("i94cit"),
        _d((c + k) % 27).alias("i94res"),
        F.concat(F.when(k % 2 == 0, "p").otherwise("P"), _s(c % 27)).alias("i94port"),
        arr.alias("arrdate"),
        mode.alias("i94mode"),
        F.when((F.col("o_orderstatus") == "O") & (k % 3 == 0), "ZZ").alias("i94addr"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(arr + _d(k % 30)).alias("depdate"),
        age.alias("i94bir"),
        _d(k % 5).alias("i94visa"),
        F.when(age.isNotNull(), _d(F.year("o_orderdate") - c % 90)).alias("biryear"),
        F.when(c % 4 == 0, "M").when(c % 4 == 1, "F").when(c % 4 == 2, "X").alias("gender"),
        F.substring("o_orderpriority", 3, 20).alias("airline"),
        F.when(F.col("o_orderstatus") == "O", "B1").when(F.col("o_orderstatus") == "F", "B2")
        .otherwise("WT").alias("visatype"),
        F.col("o_orderstatus").alias("visapost"),
    )


def _region_state():
    return F.when(F.col("r_name") == "MIDDLE EAST", F.lit(None)).otherwise(F.upper(F.substring("r_name", 1, 2)))


def ports(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Port lookup (code, city, state): one port per nation, odd codes in lower case."""
    n = nation.join(sized_broadcast(region, FIXED_SIZE), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return n.select(
        F.concat(F.when(F.col("n_nationkey") % 2 == 1, "p").otherwise("P"), _s(F.col("n_nationkey"))).alias("code"),
        F.col("n_name").alias("city"),
        _region_state().alias("state"),
    )


def countries(nation: DataFrame) -> DataFrame:
    """Country lookup (code, country) with blank-padded text codes."""
    return nation.select(F.lpad(_s(F.col("n_nationkey")), 3, " ").alias("code"), F.col("n_name").alias("country"))


def temperatures(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Raw monthly temperature readings (all text) from shipped line items.

    City = the supplier's nation; returned items read as another country;
    line 7 has a malformed date and line 6 an empty reading. Readings are
    whole or quarter degrees, so their sums are exact in binary floating
    point and averages do not depend on summation order.
    """
    sup = supplier.select("s_suppkey", "s_nationkey")
    nat = sized_broadcast(nation.select("n_nationkey", "n_name"), FIXED_SIZE)
    li = lineitem.select("l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag", "l_shipdate")
    j = li.join(sup, F.col("l_suppkey") == F.col("s_suppkey")).join(nat, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    month_text = F.date_format(F.trunc(F.col("l_shipdate").cast("date"), "month"), "yyyy-MM-dd")
    # line 5 reads 17 years earlier, so that some readings lie before the first month of the dimension
    early_text = F.date_format(F.add_months(F.trunc(F.col("l_shipdate").cast("date"), "month"), -204), "yyyy-MM-dd")
    return j.select(
        F.when(F.col("l_linenumber") == 7, "not a date").when(F.col("l_linenumber") == 5, early_text)
        .otherwise(month_text).alias("dt"),
        F.when(F.col("l_linenumber") == 6, "").otherwise(_s(F.col("l_quantity"))).alias("AverageTemperature"),
        F.concat(
            _s(F.col("l_linenumber")), F.lit("."),
            F.when(F.col("l_returnflag") == "A", "25").when(F.col("l_returnflag") == "N", "5").otherwise("75"),
        ).alias("AverageTemperatureUncertainty"),
        F.col("n_name").alias("City"),
        F.when(F.col("l_returnflag") == "R", "Mexico").otherwise("United States").alias("Country"),
        F.concat(_s(F.col("s_nationkey")), F.lit("N")).alias("Latitude"),
        F.concat(_s(F.col("l_suppkey")), F.lit("W")).alias("Longitude"),
    )


def demographics(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Raw demographics rows (all text, file header names) from customers.

    City = the customer's nation, state code = its region's first letters,
    one race row per customer; the city total repeats on every race row. Some
    rows spell the city in lower case and some have another total.
    """
    geo = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    geo = sized_broadcast(geo, FIXED_SIZE)
    j = customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    k = F.col("c_custkey")
    return j.select(
        F.when(k % 10 == 3, F.lower("n_name")).otherwise(F.col("n_name")).alias("City"),
        F.initcap("r_name").alias("State"),
        _s(F.col("c_acctbal") / 100).alias("Median Age"),
        F.concat(_s(k % 1000), F.lit(".0")).alias("Male Population"),
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(_s(k % 777)).alias("Female Population"),
        _s(F.col("n_nationkey") * 1000 + F.col("n_regionkey") + 100000 + F.when(k % 7 == 2, 1).otherwise(0))
        .alias("Total Population"),
        _s(F.col("c_nationkey") * 10).alias("Number of Veterans"),
        F.when(F.col("c_acctbal") < 0, "n/a").otherwise(_s(k % 500)).alias("Foreign-born"),
        _s(F.col("c_acctbal") / 1000).alias("Average Household Size"),
        _region_state().alias("State Code"),
        F.concat(F.col("c_mktsegment"), F.lit(" "), _s(k)).alias("Race"),
        _s(k).alias("Count"),
    )


def listening_events(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Listening log: one event per line item; returned-'A' items are song plays."""
    li = lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    p = part.select("p_partkey", "p_name", "p_brand", "p_retailprice")
    j = li.join(p, F.col("l_partkey") == F.col("p_partkey"))
    u = F.col("l_suppkey")
    return j.select(
        F.col("p_brand").alias("artist"),
        F.lit("Logged In").alias("auth"),
        F.concat(F.lit("First"), _s(u)).alias("firstname"),
        F.when(u % 2 == 0, "M").otherwise("F").alias("gender"),
        F.col("l_linenumber").cast("bigint").alias("iteminsession"),
        F.concat(F.lit("Last"), _s(u % 13)).alias("lastname"),
        F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("p_retailprice")).alias("length"),
        F.when(F.col("l_linestatus") == "O", "paid").otherwise("free").alias("level"),
        F.concat(F.lit("Region "), _s(u % 7)).alias("location"),
        F.lit("PUT").alias("method"),
        F.when(F.col("l_returnflag") == "A", "NextSong").otherwise("Home").alias("page"),
        F.lit(None).cast("double").alias("registration"),
        F.col("l_orderkey").alias("sessionid"),
        F.col("p_name").alias("song"),
        F.lit(200).cast("bigint").alias("status"),
        (epoch_ms(F.col("l_shipdate")) + F.col("l_linenumber") * 1234 + F.col("l_partkey") % 1000).alias("ts"),
        F.concat(F.lit("agent/"), F.col("l_linestatus")).alias("useragent"),
        u.alias("userid"),
    )


# Every 500th part is a song stored in this many copies.
SONG_COPIES = 24


def listening_songs(part: DataFrame) -> DataFrame:
    """Song catalogue: one song per part, some of them in many copies under ids of their own."""
    copies = F.when(F.col("p_partkey") % 500 == 1, F.sequence(F.lit(0), F.lit(SONG_COPIES - 1))).otherwise(
        F.array(F.lit(0))
    )
    part = part.withColumn("copy", F.explode(copies))
    return part.select(
        F.lit(1).cast("bigint").alias("num_songs"),
        F.concat(F.lit("AR"), F.regexp_replace("p_brand", "Brand#", "")).alias("artist_id"),
        F.col("p_brand").alias("artist_name"),
        F.col("p_size").cast("double").alias("artist_latitude"),
        (-F.col("p_size").cast("double")).alias("artist_longitude"),
        F.col("p_type").alias("artist_location"),
        F.concat(F.lit("SO"), _s(F.col("p_partkey")), F.when(F.col("copy") > 0, F.concat(F.lit("-"), _s(F.col("copy"))))
                 .otherwise(F.lit(""))).alias("song_id"),
        F.col("p_name").alias("title"),
        F.col("p_retailprice").alias("duration"),
        (F.col("p_size") + 1990).cast("bigint").alias("year"),
    )


class Inputs:
    """Lazy access to the derived inputs of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def arrivals(self) -> DataFrame:
        return arrivals(self.table("orders"))

    def ports(self) -> DataFrame:
        return ports(self.table("nation"), self.table("region"))

    def countries(self) -> DataFrame:
        return countries(self.table("nation"))

    def temperatures(self) -> DataFrame:
        return temperatures(self.table("lineitem"), self.table("supplier"), self.table("nation"))

    def demographics(self) -> DataFrame:
        return demographics(self.table("customer"), self.table("nation"), self.table("region"))

    def events(self) -> DataFrame:
        return listening_events(self.table("lineitem"), self.table("part"))

    def songs(self) -> DataFrame:
        return listening_songs(self.table("part"))
