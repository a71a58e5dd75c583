"""Queries that SQL can express, against their SQL."""

import duckdb
import pytest

from amity.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(SQL[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    rows = sorted(want.fetchall())
    assert rows and sorted(tuple(r[c] for c in columns) for r in got.collect()) == rows


def test_columns_of_any_name_stay(spark):
    """Names that the operators use themselves."""
    from amity.llm.lines import dedupe_lines
    from amity.llm.pii import sanitise
    from amity.llm.suffixes import remove_repeats

    line = "a line that is long enough to be a line of its own and stands in both, " * 2
    rows = [(1, f"{line}\nmail a@b.example"), (2, f"{line}\nand call +1 555 0100 200"), (3, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    names = ["key", "whole", "terms", "spans", "row_of_text", "row_of_line", "gone", "row", "other columns"]
    more = docs.withColumns({n: docs.doc_id for n in names})
    for operator, made in (
        (sanitise, ["spans", "sanitised"]),
        (remove_repeats, ["kept", "n_bytes", "n_removed", "n_spans"]),
        (dedupe_lines, ["n_lines", "n_removed"]),
    ):
        plain = {r.doc_id: tuple(r[c] for c in made) for r in operator(docs).collect()}
        out = operator(more)
        assert set(out.columns) >= (set(names) | set(made))
        got = out.collect()
        assert {r.doc_id: tuple(r[c] for c in made) for r in got} == plain
        assert all(r[n] == r.doc_id for r in got for n in names if n not in made)
