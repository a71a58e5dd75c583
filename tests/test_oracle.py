"""Every registered query against its SQL, run by another engine over the same files."""

import glob
import os

import duckdb
import pytest

from amity.plans.queries import QUERIES, SQL

SF_DIRS = [
    d for d in os.environ.get("ORACLE_DIRS", "/root/testdata/sf0.001,/root/testdata/sf0.01").split(",")
    if os.path.isdir(d)
]


@pytest.fixture(scope="module")
def oracles():
    connections = {}
    for sf_dir in SF_DIRS:
        con = connections[sf_dir] = duckdb.connect()
        for path in glob.glob(f"{sf_dir}/*.parquet"):
            name = os.path.basename(path).removesuffix(".parquet")
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connections


TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz"}


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=lambda r: [(x is None, x) for x in r])


def test_every_query_has_a_check():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("sf_dir", SF_DIRS)
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, oracles, name, sf_dir):
    got = QUERIES[name](spark, sf_dir)
    want_types = oracles[sf_dir].execute(f"DESCRIBE {SQL[name]}").fetchall()
    assert dict(got.dtypes) == {column: TYPES[kind] for column, kind, *_ in want_types}
    want = oracles[sf_dir].execute(SQL[name])
    want_columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(want_columns)
    got_rows = _normal(got.columns, map(tuple, got.collect()))
    want_rows = _normal(want_columns, want.fetchall())
    assert got_rows == want_rows
    assert got_rows[1], "a check on no rows proves nothing"
