"""The whole run (B10): stage files -> four tables -> contract -> load -> checks.

One Spark application reads the staged raw files, builds the fact and the
three dimensions, writes each under its contract (parquet overwrite),
optionally truncate-and-loads them into warehouse targets, and checks what
was written. Row counts and null keys are counted by the last write itself;
only uniqueness reads the key columns again.
"""

from __future__ import annotations

import configparser
import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

from arrivals_mart.operators.quality import assert_checks, checked_report, counted
from arrivals_mart.operators.sinks import create_targets, truncate_and_load, write_contract
from arrivals_mart.plans.marts import (
    build_demographics_dim,
    build_fact,
    build_person_dim,
    build_temperature_dim,
)
from arrivals_mart.schemas import (
    ARRIVALS,
    COUNTRY_LOOKUP,
    DEMOGRAPHICS_USED,
    PORT_LOOKUP,
    TABLE_KEYS,
    TARGETS,
    TEMPERATURE_USED,
)
from arrivals_mart.sources.files import read_csv, read_parquet

T = TypeVar("T")


@dataclass(frozen=True)
class StagingLayout:
    """Relative locations of the raw inputs below the staging root."""

    arrivals: str = "immigration"
    ports: str = "port_mapping"
    countries: str = "country_mapping"
    temperature: str = "temperature"
    demographics: str = "demographics"


# INI layout of a run configuration: section -> key -> what it names.
# Credentials are never read from it; object-store access comes from the
# cluster's filesystem configuration.
CONFIG_ROOTS = ("S3", "STAGING_DATA", "PRODUCTION_DATA")
CONFIG_INPUTS = {
    "IMMIGRATION": "arrivals",
    "PORT_MAPPING": "ports",
    "COUNTRY_MAPPING": "countries",
    "TEMPERATURE": "temperature",
    "DEMOGRAPHICS": "demographics",
}


def layout_from_config(path: str) -> tuple[str, str, StagingLayout]:
    """(staging root, production root, input layout) from an INI run configuration."""
    cfg = configparser.ConfigParser()
    if not cfg.read(path):
        raise FileNotFoundError(path)
    section, staging_key, production_key = CONFIG_ROOTS
    staging, production = cfg[section][staging_key], cfg[section][production_key]
    data = cfg["DATA"] if cfg.has_section("DATA") else {}
    fields = {field: data[key] for key, field in CONFIG_INPUTS.items() if key in data}
    return staging, production, StagingLayout(**fields)


def _join(root: str, rel: str) -> str:
    return rel if "://" in rel or rel.startswith("/") else os.path.join(root, rel)


def read_staging(spark: SparkSession, staging: str, layout: StagingLayout = StagingLayout()) -> dict[str, DataFrame]:
    return {
        "arrivals": read_parquet(spark, _join(staging, layout.arrivals), ARRIVALS, recursive=True),
        "ports": read_csv(spark, _join(staging, layout.ports), PORT_LOOKUP),
        "countries": read_csv(spark, _join(staging, layout.countries), COUNTRY_LOOKUP),
        "temperature": read_csv(spark, _join(staging, layout.temperature), TEMPERATURE_USED),
        "demographics": read_csv(spark, _join(staging, layout.demographics), DEMOGRAPHICS_USED, sep=";"),
    }


BUILDERS: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    "fact_immigration": lambda i: build_fact(i["arrivals"], i["ports"]),
    "dim_immigrant": lambda i: build_person_dim(i["arrivals"], i["countries"]),
    "dim_temperature": lambda i: build_temperature_dim(i["temperature"]),
    "dim_demographics": lambda i: build_demographics_dim(i["demographics"]),
}


def build_all(inputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: build(inputs) for name, build in BUILDERS.items()}


def run_concurrently(tasks: dict[str, Callable[[], T]], max_parallel: int = 4) -> dict[str, T]:
    """Run independent Spark actions from a few driver threads; the first error is raised.

    Spark schedules jobs submitted from different threads side by side, so
    a small table does not wait for a large one to finish writing.
    """
    if max_parallel <= 1 or len(tasks) <= 1:
        return {name: task() for name, task in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(max_parallel, len(tasks))) as pool:
        futures = {name: pool.submit(task) for name, task in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


def run_pipeline(
    spark: SparkSession,
    staging: str,
    production: str,
    layout: StagingLayout = StagingLayout(),
    warehouse: str | None = None,
    check: bool = True,
    max_parallel: int = 4,
    buckets: int | None = None,
    unique: bool = True,
) -> DataFrame:
    """Build, write, optionally load, and check the four tables; return the check report.

    The four tables are independent, so each is built and written by its
    own Spark job, up to ``max_parallel`` at a time. ``warehouse`` is a
    folder (or catalog database prefix) receiving the truncate-and-load
    copies; checks then run on the loaded copies. With ``check`` a failed
    check raises ValueError listing every failure. A ``warehouse`` without a
    ``/`` is a catalog database: its tables are created first (bucketed by
    the record key into ``buckets`` buckets when given).

    Null keys do not end a run at the first one: they are written and counted,
    and the checks report them together with every other failure.
    ``unique=False`` leaves out the uniqueness check and its shuffle.
    """
    inputs = read_staging(spark, staging, layout)
    if warehouse and "/" not in warehouse:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {warehouse}")
        create_targets(spark, database=warehouse, buckets=buckets)

    def publish(name: str) -> tuple[DataFrame, str, dict]:
        path, key, counts = os.path.join(production, name), TABLE_KEYS[name], []

        def observe(rows: DataFrame) -> DataFrame:
            rows, of_write = counted(rows, key)
            counts.append(of_write)
            return rows

        write_contract(BUILDERS[name](inputs), path, TARGETS[name], name, False, None if warehouse else observe)
        written = spark.read.schema(TARGETS[name]).parquet(path)
        if warehouse:
            target = os.path.join(warehouse, name) if "/" in warehouse else f"{warehouse}.{name}"
            written = truncate_and_load(spark, path, target, TARGETS[name], name, check_nulls=False, observe=observe)
        return written, key, counts[0]()

    written = run_concurrently({name: (lambda n=name: publish(n)) for name in BUILDERS}, max_parallel)
    report = checked_report(spark, written, unique)
    if check:
        assert_checks(report)
    return report
