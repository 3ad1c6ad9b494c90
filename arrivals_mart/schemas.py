"""Declared source and target schemas (K2) and the contract check (K4).

Sources are read with a declared schema (no inference). Targets are the four
star-schema tables; their column order is part of the contract because a
bulk loader matches columns by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(spec: list[tuple[str, T.DataType, bool]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in spec])


S, I, L, D, DT = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType()

# ---------------------------------------------------------------- sources
ARRIVALS = _struct(
    [
        ("cicid", D, True), ("i94yr", D, True), ("i94mon", D, True),
        ("i94cit", D, True), ("i94res", D, True), ("i94port", S, True),
        ("arrdate", D, True), ("i94mode", D, True), ("i94addr", S, True),
        ("depdate", D, True), ("i94bir", D, True), ("i94visa", D, True),
        ("biryear", D, True), ("gender", S, True), ("airline", S, True),
        ("visatype", S, True), ("visapost", S, True),
    ]
)
PORT_LOOKUP = _struct([("code", S, True), ("city", S, True), ("state", S, True)])
COUNTRY_LOOKUP = _struct([("code", S, True), ("country", S, True)])
TEMPERATURE_RAW = _struct(
    [
        ("dt", S, True), ("AverageTemperature", S, True),
        ("AverageTemperatureUncertainty", S, True), ("City", S, True),
        ("Country", S, True), ("Latitude", S, True), ("Longitude", S, True),
    ]
)
# header text of the demographics file -> snake-case column used downstream
DEMOGRAPHICS_HEADERS = {
    "City": "city",
    "State": "state",
    "Median Age": "median_age",
    "Male Population": "male_population",
    "Female Population": "female_population",
    "Total Population": "total_population",
    "Number of Veterans": "number_of_veterans",
    "Foreign-born": "foreign_born",
    "Average Household Size": "avg_household_size",
    "State Code": "state_code",
    "Race": "race",
    "Count": "count",
}
DEMOGRAPHICS_RAW = _struct([(h, S, True) for h in DEMOGRAPHICS_HEADERS])
# the columns that the builds use: a staged file may lack the others
TEMPERATURE_USED = T.StructType([f for f in TEMPERATURE_RAW if f.name not in ("Latitude", "Longitude")])
DEMOGRAPHICS_USED = T.StructType([f for f in DEMOGRAPHICS_RAW if f.name not in ("State", "Count")])

STAGING_EVENTS = _struct(
    [
        ("artist", S, True), ("auth", S, True), ("firstname", S, True),
        ("gender", S, True), ("iteminsession", L, True), ("lastname", S, True),
        ("length", D, True), ("level", S, True), ("location", S, True),
        ("method", S, True), ("page", S, True), ("registration", D, True),
        ("sessionid", L, True), ("song", S, True), ("status", L, True),
        ("ts", L, True), ("useragent", S, True), ("userid", L, True),
    ]
)
STAGING_SONGS = _struct(
    [
        ("num_songs", L, True), ("artist_id", S, True), ("artist_name", S, True),
        ("artist_latitude", D, True), ("artist_longitude", D, True),
        ("artist_location", S, True), ("song_id", S, True), ("title", S, True),
        ("duration", D, True), ("year", L, True),
    ]
)

# ---------------------------------------------------------------- targets
FACT_IMMIGRATION = _struct(
    [
        ("immigration_id", S, False), ("imm_year", I, True), ("imm_month", I, True),
        ("transport_mode", S, True), ("arrival_city_code", S, True),
        ("arrival_city", S, True), ("arrival_state", S, True),
        ("arrival_date", DT, True), ("departure_date", DT, True),
        ("travel_purpose", S, True), ("visa_type", S, True),
        ("visa_issued_state", S, True), ("airline", S, True),
    ]
)
DIM_IMMIGRANT = _struct(
    [
        ("immigration_id", S, False), ("citizenship_country", S, True),
        ("residence_country", S, True), ("age", I, True), ("birthyear", I, True),
        ("gender", S, True),
    ]
)
DIM_TEMPERATURE = _struct(
    [
        ("temp_id", I, False), ("temp_report_month", DT, True), ("city", S, True),
        ("country", S, True), ("avg_temp", D, True), ("avg_temp_uncertainty", D, True),
    ]
)
DIM_DEMOGRAPHICS = _struct(
    [
        ("demo_id", I, False), ("city", S, True), ("state_code", S, True),
        ("race", S, True), ("median_age", D, True), ("male_population", I, True),
        ("female_population", I, True), ("total_population", I, True),
        ("number_of_veterans", I, True), ("foreign_born", I, True),
        ("avg_household_size", D, True),
    ]
)

TARGETS = {
    "fact_immigration": FACT_IMMIGRATION,
    "dim_immigrant": DIM_IMMIGRANT,
    "dim_temperature": DIM_TEMPERATURE,
    "dim_demographics": DIM_DEMOGRAPHICS,
}

# table -> key column, as checked after every load
TABLE_KEYS = {
    "fact_immigration": "immigration_id",
    "dim_immigrant": "immigration_id",
    "dim_temperature": "temp_id",
    "dim_demographics": "demo_id",
}


class ContractError(ValueError):
    pass


def enforce(df: DataFrame, schema: T.StructType, name: str = "table", check_nulls: bool = True) -> DataFrame:
    """Select the contract's columns in contract order with contract types.

    Columns are found case-insensitively; extra columns are dropped; a
    missing column raises. Types are converted with ANSI casts, so a value
    that does not fit fails the job instead of silently turning null.
    Non-nullable columns carry an inline assertion evaluated while the data
    is written, so no extra pass is needed. ``check_nulls=False`` leaves null
    keys in, for a run whose quality report counts them.
    """
    by_lower = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in by_lower]
    if missing:
        raise ContractError(f"{name}: missing columns {missing}")
    cols = []
    for f in schema.fields:
        c = F.col(f"`{by_lower[f.name.lower()]}`")
        if df.schema[by_lower[f.name.lower()]].dataType != f.dataType:
            c = c.cast(f.dataType)
        if check_nulls and not f.nullable:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"{name}.{f.name} is null"))).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def schema_differences(actual: T.StructType, expected: T.StructType) -> list[str]:
    """Names, order and types that differ between a written table and its contract."""
    diffs = []
    a = [(f.name.lower(), f.dataType) for f in actual.fields]
    e = [(f.name.lower(), f.dataType) for f in expected.fields]
    if [n for n, _ in a] != [n for n, _ in e]:
        diffs.append(f"columns {[n for n, _ in a]} != {[n for n, _ in e]}")
    for (an, at), (en, et) in zip(a, e):
        if an == en and at != et:
            diffs.append(f"{an}: {at.simpleString()} != {et.simpleString()}")
    return diffs


# Tables keyed by the arrival record; bucketed alike they join without a shuffle.
RECORD_KEY_TABLES = ("fact_immigration", "dim_immigrant")


def ddl(
    table: str, schema: T.StructType, location: str | None = None, bucket_by: tuple[str, int] | None = None
) -> str:
    """``CREATE TABLE IF NOT EXISTS`` text for a contract (parquet, optional location and buckets).

    Spark keeps NOT NULL as documentation for file tables; the contract
    check and the quality checks enforce it.
    """
    cols = ",\n  ".join(
        f"`{f.name}` {f.dataType.simpleString().upper()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
    )
    buckets = ""
    if bucket_by:
        key, n = bucket_by
        buckets = f"\nCLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {n} BUCKETS"
    loc = f"\nLOCATION '{location}'" if location else ""
    return f"CREATE TABLE IF NOT EXISTS {table} (\n  {cols}\n) USING parquet{buckets}{loc}"
