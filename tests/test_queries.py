"""Queries over the driver's smallest tables against their SQL."""

import os

import pytest

from wildtally.plans import registry, rules

FOLDER = "/root/testdata/sf0.001"
TABLES = ("events", "orders", "lineitem", "part", "supplier", "customer", "nation")
QUERIES = registry.QUERIES | rules.QUERIES
#: Queries over the same events as species_totals and graded_events, left to the driver's comparison.
SLOW = ("event_species", "events", "activity_by_hour", "camera_health", "species_by_camera", "overview", "hour_grid", "hour_shares", "species_camera_cells", "largest_sightings", "graded", "species_bars")


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    return value.isoformat() if hasattr(value, "isoformat") else value


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables aren't here")
@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    query, sql = QUERIES[name]
    df = query(spark, FOLDER)
    found = con.execute(sql)
    order = [[c[0] for c in found.description].index(c) for c in sorted(df.columns)]
    want = [tuple(plain(r[k]) for k in order) for r in found.fetchall()]
    got = [tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()]
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_every_query_has_sql():
    assert set(QUERIES) == set(registry.queries()) | set(rules.queries()) == set(registry.oracle_sql()) | set(rules.oracle_sql())
