"""Every query of the event engine against its SQL in DuckDB, on the smallest sample tables."""

import duckdb
import pytest

from tidemark.plans import catalog

FOLDER = "/root/testdata/sf0.001"
#: Queries of which the smallest tables have no rows.
LARGER = {"geo_device_threshold": "/root/testdata/sf0.01"}
TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def duck():
    found = {}

    def of(folder):
        if folder not in found:
            found[folder] = duckdb.connect()
            for t in TABLES:
                found[folder].execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
        return found[folder]

    return of


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    folder = LARGER.get(name, FOLDER)
    got = catalog.queries()[name](spark, folder)
    want = duck(folder).execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    rows = _rows(columns, want.fetchall())
    assert rows, "an empty comparison proves nothing"
    assert _rows(got.columns, got.collect()) == rows


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
