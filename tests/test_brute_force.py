"""Random small networks against plain Python, and relations between the operators."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from amity import operators as ops
from amity.schemas import ACCESS_LOGS, ASSOCIATES, USERS
from amity.sources import views

ids = st.one_of(st.integers(0, 6), st.just(3))
networks = st.tuples(
    st.lists(st.tuples(ids, ids), max_size=25),
    st.lists(st.tuples(ids, ids, st.integers(-5, 40)), max_size=25),
    st.sets(st.integers(0, 8)),
)


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(network=networks)
def test_random_networks(spark, rows, network):
    edges, visits, people = network
    users = spark.createDataFrame([(p, f"N{p}", f"C{p % 2}", 1, "H") for p in people], USERS)
    associates = spark.createDataFrame(
        [(i, a, b, 1, "Friend") for i, (a, b) in enumerate(edges)], ASSOCIATES
    )
    logs = spark.createDataFrame(
        [(i, v, p, "Viewed", t) for i, (v, p, t) in enumerate(visits)], ACCESS_LOGS
    )

    seen = {(v, p) for v, p, _ in visits}
    unvisited = set(edges) - seen
    owners = {a for a, _ in edges}
    friendly = {a for a, b in edges if (a, b) in seen}
    ends = Counter(x for e in edges for x in e)
    degrees = Counter(a for a, _ in edges)
    pages = Counter(p for _, p, _ in visits)
    last = {}
    for v, _, t in visits:
        last[v] = max(last.get(v, 0), t)

    assert rows(ops.unvisited_friend_pairs(associates, logs)) == sorted(unvisited)
    assert rows(ops.owners_with_unvisited_friend(associates, logs)) == sorted({(a,) for a, _ in unvisited})
    assert rows(ops.owners_visiting_no_friend(associates, logs)) == sorted((a,) for a in owners - friendly)
    assert rows(ops.relationship_counts(users, associates)) == sorted((p, f"N{p}", ends[p]) for p in people)
    assert rows(ops.owner_degrees(associates)) == sorted(degrees.items())
    assert rows(ops.popularity_labels(associates, users=users)) == sorted(
        (p, "More Popular" if degrees[p] > 1 else "Not More Popular") for p in people
    )
    assert rows(ops.access_stats(logs)) == sorted(
        (v, sum(x[0] == v for x in visits), len({p for w, p in seen if w == v})) for v in last
    )
    top = sorted(pages.items(), key=lambda r: (-r[1], r[0]))[:3]
    assert [tuple(r) for r in ops.top_pages(logs, users, k=3).collect()] == [
        (p, *((f"N{p}", f"C{p % 2}") if p in people else ("Unknown", "Unknown")), n) for p, n in top
    ]
    assert rows(ops.inactive_users(logs, 30, 10)) == sorted((v,) for v, t in last.items() if 30 - t > 10)


@pytest.fixture(scope="module")
def tables(spark):
    sf_dir = "/root/testdata/sf0.01"
    return [f(spark, sf_dir) for f in (views.users, views.associates, views.access_logs)]


def test_relations_between_operators(tables):
    users, associates, logs = tables
    by_nation = {r.Nationality: r.n for r in ops.users_per_nationality(users).collect()}
    assert sum(by_nation.values()) == users.count()
    assert ops.users_by_nationality(users, "NATION_3").count() == by_nation["NATION_3"]

    counts = ops.relationship_counts(users, associates)
    known = {r.ID for r in users.select("ID").collect()}
    ends = [x for r in associates.select("PersonA_ID", "PersonB_ID").collect() for x in r]
    assert counts.agg({"n": "sum"}).first()[0] == sum(x in known for x in ends)

    stats = ops.access_stats(logs)
    assert stats.agg({"total": "sum"}).first()[0] == logs.count()
    assert stats.where("distinct_pages > total").count() == 0

    some = ops.owners_with_unvisited_friend(associates, logs)
    assert ops.owners_visiting_no_friend(associates, logs).subtract(some).count() == 0
    pairs = associates.select("PersonA_ID", "PersonB_ID").distinct()
    visits = logs.selectExpr("ByWho AS PersonA_ID", "WhatPage AS PersonB_ID")
    unvisited = ops.unvisited_friend_pairs(associates, logs).count()
    assert unvisited + pairs.intersect(visits).count() == pairs.count()
    assert ops.popularity_labels(associates).count() == pairs.select("PersonA_ID").distinct().count()


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all friendships and accesses belongs to one pair, and a third to one owner."""
    def pick(n, others):
        return F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, n).otherwise(others)

    base = spark.range(90_000)
    a = pick(7, F.col("id") % 1_000).cast("bigint")
    b = pick(F.col("id") % 30_000, F.col("id") % 977).cast("bigint")
    return (
        base.select(F.col("id").alias("FriendRel"), a.alias("PersonA_ID"), b.alias("PersonB_ID")),
        base.select(
            F.col("id").alias("AccessId"), a.alias("ByWho"), (b % 500).alias("WhatPage"),
            F.lit("Viewed").alias("TypeOfAccess"), F.col("id").alias("AccessTime"),
        ),
    )


def test_hot_keys_give_whole_results(hot, rows):
    associates, logs = hot
    edges = [tuple(r) for r in associates.select("PersonA_ID", "PersonB_ID").collect()]
    seen = {tuple(r) for r in logs.select("ByWho", "WhatPage").collect()}
    assert rows(ops.unvisited_friend_pairs(associates, logs)) == sorted(set(edges) - seen)
    owners, friendly = {a for a, _ in edges}, {a for a, b in edges if (a, b) in seen}
    assert rows(ops.owners_visiting_no_friend(associates, logs)) == sorted((a,) for a in owners - friendly)
    total = dict((r[0], r[1:]) for r in rows(ops.access_stats(logs)))
    assert total[7] == (sum(r.ByWho == 7 for r in logs.select("ByWho").collect()), len({p for v, p in seen if v == 7}))
    assert dict(rows(ops.owner_degrees(associates)))[7] == sum(a == 7 for a, _ in edges)


def test_hot_pair_is_merged_before_the_shuffle(hot):
    """What crosses the wire is at most one row per distinct pair and task."""
    associates, logs = hot
    df = ops.unvisited_friend_pairs(associates, logs)
    df.collect()
    sent = []

    def walk(node):
        if node.nodeName() == "Exchange":
            sent.append(node.metrics().apply("shuffleRecordsWritten").value())
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            walk(node.plan())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    task = F.spark_partition_id()
    distinct = associates.select(task, "PersonA_ID", "PersonB_ID").distinct().count()
    distinct += logs.select(task, "ByWho", "WhatPage").distinct().count()
    assert sent == [distinct] and distinct < 0.6 * (associates.count() + logs.count())
