"""Every registered query of the core against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from tablemill import queries

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(D):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{D}/{f}'")
    return c


def shown(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(f"{r[i]:.9g}" if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, D)
    want = duck.execute(queries.SQL[name])
    assert shown([tuple(r) for r in df.collect()], df.columns) == shown(want.fetchall(), [c[0] for c in want.description])


@pytest.mark.parametrize("table", queries.TABLES)
def test_profiles_have_each_tables_first_ten_columns(spark, duck, table):
    own = [r[0] for r in duck.execute(f"DESCRIBE {table}").fetchall()][:10]
    name = f"profile_full_{table}" if f"profile_full_{table}" in queries.QUERIES else f"profile_{table}"
    assert sorted(r.column_name for r in queries.QUERIES[name](spark, D).collect()) == sorted(own) == sorted(queries.SCHEMA[table])
