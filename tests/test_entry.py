import os

import duckdb
import pytest

import __spark_entry__ as E
from arrivals_mart.plans import catalog

SMOKE = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("arrival_city", "string"),
        ("total_population", "int"),
        ("immigration_count", "bigint"),
    ]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(E.queries())
    assert set(catalog.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


FAST = ["fact_build", "dim_person_build", "surrogate_key_two_level", "surrogate_key_three_level",
        "top_city_arrivals", "songplays", "label_dictionary", "quality_report", "trailing_temperature_as_of",
        "incremental_fact", "star_join", "role_playing_lookup", "label_port_lookup", "time_dimension"]


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")
@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle_on_smallest_tables(spark, name):
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    df = E.queries()[name](spark, SMOKE)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(df.columns)

    def norm(recs, cols):
        idx = [cols.index(c) for c in order]
        return sorted((tuple(r[i] for i in idx) for r in recs), key=repr)

    assert norm([tuple(r) for r in df.collect()], df.columns) == norm(res.fetchall(), ocols)


def test_plans_document_covers_every_query():
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path) as fh:
        headers = {line[4:].strip() for line in fh if line.startswith("### ")}
    assert headers == set(catalog.QUERIES), "regenerate PLANS.md with scripts/show_plans.py"
