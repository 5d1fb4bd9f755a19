"""Every query that has SQL against DuckDB, on the smallest tables."""

import duckdb
import pytest

from loomtext.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    one = lambda v: None if v is None else round(float(v), 5) if isinstance(v, float) or type(v).__name__ == "Decimal" else v
    return sorted(repr([one(r[i]) for i in order]) for r in rows)


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query(spark, duck, sf, name):
    df = registry.QUERIES[name](spark, sf)
    found = duck.execute(registry.SQL[name])
    columns = [x[0] for x in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(found.fetchall(), columns)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 4
    assert set(e.oracle_sql()) <= set(e.queries())
