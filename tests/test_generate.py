"""Synthetic tables: sizes, ranges, and the same rows on every run."""

import pytest
from pyspark.sql import functions as F

from amity import generate as g
from amity import operators as ops
from amity.schemas import ACCESS_LOGS, ASSOCIATES, USERS


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 201])
def test_all_pairs_in_order(spark, n):
    got = g.generate_associates(spark, n, 10**9).select("FriendRel", "PersonA_ID", "PersonB_ID")
    pairs = [(i, j) for i in range(1, n + 1) for j in range(i + 1, n + 1)]
    assert sorted(map(tuple, got.collect())) == [(r, *p) for r, p in enumerate(pairs, 1)]


def test_cut_after_max_rel(spark, rows):
    got = g.generate_associates(spark, 5, 6).select("PersonA_ID", "PersonB_ID")
    assert rows(got) == [(1, 2), (1, 3), (1, 4), (1, 5), (2, 3), (2, 4)]


def test_default_size(spark):
    """Owners 1 to 101 hold all edges, the first 199,999 of them."""
    degrees = ops.owner_degrees(g.generate_associates(spark))
    top = degrees.orderBy("PersonA_ID").limit(5).collect()
    assert [(r.PersonA_ID, r.n) for r in top] == [(i, 200_000 - i) for i in range(1, 6)]
    last = degrees.agg(F.max("PersonA_ID"), F.max_by("n", "PersonA_ID"), F.sum("n")).first()
    assert tuple(last) == (101, 5050, 20_000_000)


def test_pair_formula_is_exact_for_very_many_users(spark):
    """Owner boundaries at the largest size, where floating point alone is not enough."""
    n = 3_000_000_000
    before = lambda i: (i - 1) * (2 * n - i) // 2
    for owner in (1, 2, 12_345_678, 1_499_999_000, n - 2, n - 1):
        for row, want in [
            (before(owner) + 1, (owner, owner + 1)),
            (before(owner + 1), (owner, n)),
        ]:
            made = g.associates_rows(spark.range(row, row + 1).toDF("FriendRel"), n)
            assert [(r.PersonA_ID, r.PersonB_ID) for r in made.collect()] == [want]


def test_schemas(spark):
    assert g.generate_users(spark, 5).dtypes == spark.createDataFrame([], USERS).dtypes
    assert g.generate_associates(spark, 5, 5).dtypes == spark.createDataFrame([], ASSOCIATES).dtypes
    assert g.generate_access_logs(spark, 5, 5).dtypes == spark.createDataFrame([], ACCESS_LOGS).dtypes


def test_values(spark):
    users = g.generate_users(spark, 20_000)
    assert {r.Hobby for r in users.select("Hobby").distinct().collect()} == set(g.HOBBIES)
    codes = users.agg(F.min("CountryCod"), F.max("CountryCod"), F.count_distinct("CountryCod"))
    assert tuple(codes.first()) == (1, 50, 50)
    logs = g.generate_access_logs(spark, 50_000, 100)
    spread = logs.groupBy("ByWho").count().agg(F.min("ByWho"), F.max("ByWho"), F.min("count"))
    low, high, least = spread.first()
    assert (low, high) == (1, 100) and least > 350
    assert {r[0] for r in logs.select("TypeOfAccess").distinct().collect()} == set(g.ACCESS_TYPES)
    times = logs.agg(F.min("AccessTime"), F.max("AccessTime")).first()
    assert 1 <= times[0] and times[1] <= 1_000_000


def test_partitioning_does_not_change_rows(spark, rows):
    a = g.generate_access_logs(spark, 500, 50, seed=3)
    b = a.sparkSession.range(1, 501, numPartitions=3)
    assert b.rdd.getNumPartitions() != a.rdd.getNumPartitions()
    again = g.access_log_rows(b.toDF("AccessId"), 50, 3)
    assert rows(a) == rows(again)
    assert rows(a) != rows(g.generate_access_logs(spark, 500, 50, seed=4))


def test_generated_tables_keep_the_contract(spark):
    n = 300
    report = ops.contract_violations(
        g.generate_users(spark, n), g.generate_associates(spark, n, 5_000),
        g.generate_access_logs(spark, 2_000, n), max_id=n,
    )
    assert {r.n for r in report.collect()} == {0}
