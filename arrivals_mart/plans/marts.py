"""The four star-schema builds.

Each build is one lazy DataFrame plan: Catalyst prunes the arrival columns
to those used, pushes the record filters into the scan, broadcasts the
size-checked code lookups and turns the null-rejected outer port join into
an inner join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals_mart.functions.casts import int_key, tolerant_date, tolerant_double, tolerant_int
from arrivals_mart.functions.codes import TRANSPORT_MODES, TRAVEL_PURPOSES, decode
from arrivals_mart.functions.dates import from_day_number
from arrivals_mart.operators.keys import dense_key
from arrivals_mart.operators.lookups import DEFAULT_MAX_LOOKUP_ROWS, lookup_join, row_count_at_most
from arrivals_mart.schemas import DEMOGRAPHICS_HEADERS, DIM_DEMOGRAPHICS, DIM_TEMPERATURE
from arrivals_mart.sources.files import rename_headers

# The temperature dimension keeps one country from a start month on.
TEMPERATURE_COUNTRY = "United States"
TEMPERATURE_SINCE = "1980-01-01"


def build_fact(arrivals: DataFrame, ports: DataFrame, max_lookup_rows: int = DEFAULT_MAX_LOOKUP_ROWS) -> DataFrame:
    """fact_immigration: one row per arrival record with a known port and arrival date."""
    # no date without a day number; the parquet scan takes this test over
    i = arrivals.filter(F.col("arrdate").isNotNull()).alias("i")
    joined = lookup_join(
        i, ports, [F.col("i.i94port")], ["code"], how="left",
        case_insensitive=True, max_rows=max_lookup_rows, alias="p",
    )
    fact = joined.select(
        int_key(F.col("i.cicid")).alias("immigration_id"),
        tolerant_int(F.col("i.i94yr")).alias("imm_year"),
        tolerant_int(F.col("i.i94mon")).alias("imm_month"),
        decode(F.col("i.i94mode"), TRANSPORT_MODES).alias("transport_mode"),
        F.col("i.i94port").alias("arrival_city_code"),
        F.col("p.city").alias("arrival_city"),
        F.coalesce(F.col("i.i94addr"), F.col("p.state")).alias("arrival_state"),
        from_day_number(F.col("i.arrdate")).alias("arrival_date"),
        from_day_number(F.col("i.depdate")).alias("departure_date"),
        decode(F.col("i.i94visa"), TRAVEL_PURPOSES).alias("travel_purpose"),
        F.col("i.visatype").alias("visa_type"),
        F.col("i.visapost").alias("visa_issued_state"),
        F.col("i.airline").alias("airline"),
    )
    return fact.filter(F.col("arrival_city").isNotNull() & F.col("arrival_date").isNotNull())


def build_person_dim(
    arrivals: DataFrame, countries: DataFrame, max_lookup_rows: int = DEFAULT_MAX_LOOKUP_ROWS
) -> DataFrame:
    """dim_immigrant: travellers with gender M/F and a known age, with both countries decoded."""
    # the plain null test is what the parquet scan can take over
    known_age = F.col("i94bir").isNotNull() & tolerant_int(F.col("i94bir")).isNotNull()
    kept = arrivals.filter(F.col("gender").isin("M", "F") & known_age)
    i = kept.alias("i")
    numbered = countries.select(tolerant_int(F.col("code")).alias("code_num"), F.col("country"))
    small = row_count_at_most(numbered, max_lookup_rows)  # one check for both roles
    cit = lookup_join(i, numbered, [tolerant_int(F.col("i.i94cit"))], ["code_num"], alias="c1", broadcast=small)
    res = lookup_join(cit, numbered, [tolerant_int(F.col("i.i94res"))], ["code_num"], alias="c2", broadcast=small)
    return res.select(
        int_key(F.col("i.cicid")).alias("immigration_id"),
        F.col("c1.country").alias("citizenship_country"),
        F.col("c2.country").alias("residence_country"),
        tolerant_int(F.col("i.i94bir")).alias("age"),
        tolerant_int(F.col("i.biryear")).alias("birthyear"),
        F.col("i.gender").alias("gender"),
    )


def monthly_temperatures(
    raw: DataFrame, country: str = TEMPERATURE_COUNTRY, since: str = TEMPERATURE_SINCE
) -> DataFrame:
    """Average temperature per (month, city, country) for one country from ``since`` on.

    Duplicate readings of a month are averaged; empty or malformed readings
    are ignored by the average. The filters are on grouping keys, so they
    run before the aggregation.
    """
    raw = raw.toDF(*[c.lower() for c in raw.columns])  # header case differs between files
    typed = raw.select(
        tolerant_date(F.col("dt")).alias("temp_report_month"),
        F.col("city"),
        F.col("country"),
        tolerant_double(F.col("averagetemperature")).alias("t"),
        tolerant_double(F.col("averagetemperatureuncertainty")).alias("u"),
    )
    kept = typed.filter((F.col("country") == country) & (F.col("temp_report_month") >= F.lit(since).cast("date")))
    return kept.groupBy("temp_report_month", "city", "country").agg(
        F.avg("t").alias("avg_temp"), F.avg("u").alias("avg_temp_uncertainty")
    )


def _int_id(name: str):
    """A dense key as the contract's 32-bit id; the build fails plainly beyond it."""
    too_large = F.raise_error(F.lit(f"{name} exceeds 2147483647, the contract's 32-bit id"))
    return F.when(F.col(name) > 2**31 - 1, too_large).otherwise(F.col(name)).cast("int").alias(name)


def build_temperature_dim(
    raw: DataFrame, country: str = TEMPERATURE_COUNTRY, since: str = TEMPERATURE_SINCE
) -> DataFrame:
    """dim_temperature: monthly city averages keyed by temp_id in (month, city) order."""
    keyed = dense_key(monthly_temperatures(raw, country, since), ["temp_report_month", "city"], "temp_id")
    return keyed.select(
        _int_id("temp_id"),
        *[f.name for f in DIM_TEMPERATURE.fields if f.name != "temp_id"],
    )


def typed_demographics(raw: DataFrame) -> DataFrame:
    """Demographics with snake-case names and tolerant numeric types."""
    d = rename_headers(raw, DEMOGRAPHICS_HEADERS)
    return d.select(
        F.col("city"),
        F.col("state_code"),
        F.col("race"),
        tolerant_double(F.col("median_age")).alias("median_age"),
        tolerant_int(F.col("male_population")).alias("male_population"),
        tolerant_int(F.col("female_population")).alias("female_population"),
        tolerant_int(F.col("total_population")).alias("total_population"),
        tolerant_int(F.col("number_of_veterans")).alias("number_of_veterans"),
        tolerant_int(F.col("foreign_born")).alias("foreign_born"),
        tolerant_double(F.col("avg_household_size")).alias("avg_household_size"),
    )


def build_demographics_dim(raw: DataFrame) -> DataFrame:
    """dim_demographics: one row per (city, state, race) keyed by demo_id in that order."""
    keyed = dense_key(typed_demographics(raw), ["city", "state_code", "race"], "demo_id")
    return keyed.select(
        _int_id("demo_id"),
        *[f.name for f in DIM_DEMOGRAPHICS.fields if f.name != "demo_id"],
    )
