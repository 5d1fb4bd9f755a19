"""The queries of the ten operators that SQL can state, against DuckDB."""

import duckdb
import pytest

from loomtext.llm import queries


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    one = lambda v: round(v, 3) if isinstance(v, float) else v
    return sorted(repr([one(r[i]) for i in order]) for r in rows)


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in ("documents", "labels", "pages", "embeddings", "benchmark"):
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, duck, sf, name):
    df = queries.QUERIES[name](spark, sf)
    found = duck.execute(queries.SQL[name])
    columns = [x[0] for x in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(found.fetchall(), columns)
