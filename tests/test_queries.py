"""Every query against its SQL twin, on the smallest data folder."""

import duckdb
import pytest

from aerofield.plans import (
    catalogue,
    documents,  # noqa: F401  (its queries are in the catalogue)
)

from .conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(str)
    return list(frame.columns), sorted(map(tuple, frame.values.tolist()))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_matches_sql(spark, duck, name):
    got = rows(catalogue.QUERIES[name](spark, SF).toPandas())
    want = rows(duck.execute(catalogue.ORACLES[name]).df())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry_and_registration(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_range_join_is_no_nested_loop(spark):
    plan = catalogue.point_to_area(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
