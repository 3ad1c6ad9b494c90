"""Analyses over the star."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrivals_mart.functions.dates import month_start
from arrivals_mart.operators.joins import complete_condition, spread_incomplete_keys, spread_key
from arrivals_mart.operators.lookups import sized_broadcast
from arrivals_mart.operators.windows import top_k, trailing_average


def top_cities(demographics: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most populous (city, state_code, total_population) triples.

    Race rows repeat a city's totals, so the triples are de-duplicated first.
    Unknown populations sort last; ties are broken by city and state.
    """
    cities = demographics.select("city", "state_code", "total_population").distinct()
    order = [F.col("total_population").desc_nulls_last(), F.col("city").asc(), F.col("state_code").asc()]
    return top_k(cities, order, k)


def _top_places(demographics: DataFrame, k: int, *more: str) -> DataFrame:
    """The top cities as (lower-case city, lower-case state, more...), each once.

    A city may stand among the top rows with several totals or spellings; a
    fact must still meet it once. At most ``k`` rows, so it is broadcast.
    """
    places = top_cities(demographics, k).select(
        F.lower("city").alias("_city"), F.lower("state_code").alias("_state"), *more
    )
    return F.broadcast(places.distinct())


def _matches_top(fact: DataFrame, top: DataFrame):
    return (F.lower(fact["arrival_city"]) == top["_city"]) & (F.lower(fact["arrival_state"]) == top["_state"])


def top_city_arrivals(fact: DataFrame, demographics: DataFrame, k: int = 10) -> DataFrame:
    """Arrivals per city and total for the ``k`` most populous cities, most arrivals first.

    A city with two totals has a row for each; two spellings of one total are one city.
    """
    top = _top_places(demographics, k, "total_population")
    joined = fact.join(top, _matches_top(fact, top), "inner")
    counted = joined.groupBy(fact["arrival_city"], top["total_population"]).agg(
        F.count(fact["immigration_id"]).alias("immigration_count")
    )
    return counted.orderBy(F.col("immigration_count").desc(), F.col("arrival_city"), F.col("total_population"))


def top_city_share(fact: DataFrame, demographics: DataFrame, k: int = 10) -> DataFrame:
    """Share (percent) of all arrivals that land in the ``k`` most populous cities."""
    top = _top_places(demographics, k).withColumn("_top", F.lit(True))
    joined = fact.join(top, _matches_top(fact, top), "left")
    out = joined.agg(
        F.count(fact["immigration_id"]).alias("total_arrivals"),
        F.count(F.when(F.col("_top"), fact["immigration_id"])).alias("covered_arrivals"),
    )
    return out.withColumn(
        "share_pct",
        F.round(F.col("covered_arrivals").cast("double") * 100.0 / F.col("total_arrivals"), 4),
    )


def monthly_arrivals(fact: DataFrame) -> DataFrame:
    """Arrivals per (lower-case city, arrival month)."""
    return fact.groupBy(
        F.lower("arrival_city").alias("city"), month_start(F.col("arrival_date")).alias("month")
    ).agg(F.count("immigration_id").alias("arrivals"))


def trailing_temperatures(temperature: DataFrame, months: int = 3) -> DataFrame:
    """Trailing ``months``-month average temperature per (lower-case city, month)."""
    monthly = temperature.groupBy(
        F.lower("city").alias("city"), month_start(F.col("temp_report_month")).alias("month")
    ).agg(F.avg("avg_temp").alias("avg_temp"))
    return trailing_average(monthly, ["city"], "month", "avg_temp", months, "trailing_avg_temp")


def trailing_temperature_vs_arrivals(
    fact: DataFrame, temperature: DataFrame, months: int = 3, as_of: bool = False
) -> DataFrame:
    """Monthly arrivals per city next to the city's trailing average temperature.

    Temperature carries a city but no state, so cities of the same name
    share one series. By default the months must be equal and arrival
    months without temperature keep a null average. With ``as_of`` each
    arrival month takes the latest temperature month at or before it
    (``temp_month`` tells which).
    """
    arrivals = monthly_arrivals(fact)
    temps = trailing_temperatures(temperature, months).select("city", "month", "trailing_avg_temp")
    if not as_of:
        return arrivals.join(temps, ["city", "month"], "left")
    return _as_of_latest(arrivals, temps)


def _as_of_latest(arrivals: DataFrame, temps: DataFrame) -> DataFrame:
    """Per city, attach the latest temperature row whose month is <= the arrival month.

    Both sides hold one row per (city, month), so the city window sees at
    most two rows per month of history, however many raw rows a city has.
    Temperature rows sort before arrival rows of the same month.
    """
    t = temps.select(
        "city", "month", F.lit(None).cast("bigint").alias("arrivals"),
        F.struct(F.col("month").alias("m"), F.col("trailing_avg_temp").alias("v")).alias("_t"),
        F.lit(0).alias("_kind"),
    )
    a = arrivals.select(
        "city", "month", "arrivals", F.lit(None).cast(t.schema["_t"].dataType).alias("_t"), F.lit(1).alias("_kind")
    )
    w = Window.partitionBy("city").orderBy("month", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    tagged = a.unionByName(t).withColumn("_last", F.last("_t", ignorenulls=True).over(w))
    return tagged.filter(F.col("_kind") == 1).select(
        "city", "month", "arrivals",
        F.col("_last.v").alias("trailing_avg_temp"),
        F.col("_last.m").alias("temp_month"),
    )


def arrivals_in_warm_months(fact: DataFrame, temperatures: DataFrame, at_least: float) -> DataFrame:
    """Arrivals per month for the months in which some city's average temperature reached ``at_least``.

    On a fact that is partitioned by ``imm_year`` and ``imm_month`` only the folders of those months are read: the months are
    found at run time, and the broadcast that joins them prunes the scan. There is one row per month of history at most.
    """
    warm = temperatures.filter(F.col("avg_temp") >= at_least).select(
        F.year("temp_report_month").alias("imm_year"), F.month("temp_report_month").alias("imm_month")).distinct()
    months = fact.join(sized_broadcast(warm), ["imm_year", "imm_month"])
    return months.groupBy("imm_year", "imm_month").agg(F.count(F.lit(1)).alias("arrivals"))


def star_join(fact: DataFrame, person: DataFrame, scatter_null_keys: bool = True) -> DataFrame:
    """Fact rows with their traveller attributes; facts without a traveller row are kept.

    Facts without a record key cannot match; by default they are scattered
    instead of meeting in one task. Loaded tables have non-null keys by
    contract, so ``scatter_null_keys=False`` joins on the plain key, which
    lets two tables bucketed by it join without any shuffle.
    """
    p = person.select("immigration_id", "citizenship_country", "residence_country", "age", "gender").alias("p")
    f = fact.select("immigration_id", "arrival_city", "arrival_date", "transport_mode", "arrival_city_code")
    if scatter_null_keys:
        f = spread_incomplete_keys(
            f, ["immigration_id"], "immigration_id", ["arrival_city_code", "arrival_date", "arrival_city"]
        ).alias("f")
        cond = (F.col(f"f.{spread_key('immigration_id')}") == F.col("p.immigration_id")) & complete_condition("f")
    else:
        f = f.alias("f")
        cond = F.col("f.immigration_id") == F.col("p.immigration_id")
    joined = f.join(p, cond, "left")
    return joined.select(
        "f.immigration_id", "f.arrival_city", "f.arrival_date", "f.transport_mode",
        "p.citizenship_country", "p.residence_country", "p.age", "p.gender",
    )
