"""The physical plans of the operators on files: what is read, shuffled and broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from amity import generate, layouts
from amity import operators as ops
from amity.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Parquet tables, and a session setting under which nothing is small enough to broadcast."""
    path = tmp_path_factory.mktemp("tables")
    made = {
        "users": generate.generate_users(spark, 500),
        "associates": generate.generate_associates(spark, 500, 5_000),
        "logs": generate.generate_access_logs(spark, 5_000, 500),
    }
    read = {}
    for name, df in made.items():
        df.write.parquet(f"{path}/{name}")
        read[name] = spark.read.parquet(f"{path}/{name}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield read
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    return sorted(re.findall(r"FileScan parquet \[([^\]]*)\]", re.sub(r"#\d+L?", "", text)))


def test_filter_reaches_the_scan_and_nothing_is_shuffled(tables):
    text = plan(ops.users_by_nationality(tables["users"]))
    assert "EqualTo(Nationality,India)" in text and "Exchange" not in text
    assert read_columns(text) == ["Name,Nationality,Hobby"]


@pytest.mark.parametrize(
    "build, shuffles, columns",
    [
        (lambda t: ops.users_per_nationality(t["users"]), 1, ["Nationality"]),
        (lambda t: ops.users_per_country_code(t["users"]), 1, ["CountryCod"]),
        (lambda t: ops.access_stats(t["logs"]), 2, ["ByWho,WhatPage"]),
        (lambda t: ops.relationship_counts(t["users"], t["associates"]), 2,
         ["ID,Name", "PersonA_ID,PersonB_ID"]),
        (lambda t: ops.unvisited_friend_pairs(t["associates"], t["logs"]), 1,
         ["ByWho,WhatPage", "PersonA_ID,PersonB_ID"]),
        (lambda t: ops.owners_visiting_no_friend(t["associates"], t["logs"]), 2,
         ["ByWho,WhatPage", "PersonA_ID,PersonB_ID"]),
        (lambda t: ops.inactive_users(t["logs"], 10**6), 1, ["ByWho,AccessTime"]),
        (lambda t: ops.popularity_labels(t["associates"]), 1, ["PersonA_ID"]),
        (lambda t: ops.popularity_labels(t["associates"], users=t["users"]), 2, ["ID", "PersonA_ID"]),
        (lambda t: ops.owner_degree_profiles(t["associates"], t["users"]), 2,
         ["ID,Name,Nationality,CountryCod,Hobby", "PersonA_ID"]),
    ],
    ids=["C1", "C2", "E", "D", "F1", "F2", "G", "H1", "H3", "H2"],
)
def test_shuffles_and_columns(tables, build, shuffles, columns):
    text = plan(build(tables))
    assert text.count("Exchange hashpartitioning") == text.count("Exchange") == shuffles
    # every shuffle but that of the profiles carries rows that were grouped map-side
    profiles = "Name" in " ".join(columns)
    assert len(re.findall(r"Exchange hashpartitioning.*\n[^\n]*HashAggregate\(", text)) == shuffles - profiles
    assert read_columns(text) == columns


@pytest.mark.parametrize("k", [10, 1000])
def test_top_pages_joins_by_the_size_of_its_limit(spark, tables, k):
    """The users are too large to be broadcast, the report is not; nothing but sizes says so."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "60000b")
    try:
        wide = tables["users"].withColumn("Name", F.repeat("Name", F.lit(1000)))
        df = ops.top_pages(tables["logs"], wide, k=k)
        df.collect()
        final = plan(df).split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    assert final.count("FileScan parquet") == 2, "the accesses are read once"
    assert final.count("BroadcastHashJoin") == 2


def test_the_page_is_parsed_once(spark):
    for name in ("visits_per_page", "access_stats", "unvisited_friend_pairs"):
        text = plan(QUERIES[name](spark, SF))
        assert text.count("get_json_object") == text.count("events.parquet") == 1, name


def test_profiles_are_not_sorted_or_grouped(tables):
    text = plan(ops.relationship_counts(tables["users"], tables["associates"]))
    assert "SortAggregate" not in text and text.count("HashAggregate") == 2


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_leaves_the_jvm_or_builds_a_product(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "CollectLimit", "collect_"):
        assert bad not in text


@pytest.mark.parametrize("name", ["read_associates", "split_merged", "owners_visiting_no_friend_merged", "unclosed_quotes"])
def test_lines_are_split_in_compiled_code(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # which compiles stages only as they run
    try:
        steps = [x for x in plan(QUERIES[name](spark, SF)).splitlines() if "Generate explode(array(CASE" in x]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert steps and all(re.search(r"\*\(\d+\) Generate", step) for step in steps)


def test_the_sieve_is_before_the_shuffle_of_visits(tables):
    text = plan(ops.unvisited_friend_pairs(tables["associates"], tables["logs"], sieve_bits=1 << 12))
    # The visits' side, from the scan up: the sieve's join, and only then the grouping and the one shuffle of pairs.
    assert text.count("BroadcastHashJoin") == 1 and text.count("SortMergeJoin") == 0
    assert len(re.findall(r"Exchange hashpartitioning\(PersonA_ID", text)) == 1
    pairs, below = text.split("Exchange hashpartitioning(PersonA_ID", 1)
    assert "BroadcastHashJoin" in below and "BroadcastHashJoin" not in pairs


def test_a_sieve_has_no_more_rows_than_words(spark, tables):
    from amity.operators.friends import pair_sieve

    assert pair_sieve(tables["associates"], 1 << 10).count() == 16


def test_bitmaps_send_fewer_rows_than_pairs(spark):
    from amity.sources import views

    visits = views.part_visits(spark, "/root/testdata/sf0.01")
    pairs = visits.select("ByWho", "WhatPage").distinct().count()
    assert ops.page_bitmaps(visits).count() < pairs / 2
    text = plan(ops.access_stats(visits))
    assert "SortAggregate" not in text and "ObjectHash" not in text


def test_friendships_are_read_once_for_all_their_rules(tables):
    text = plan(ops.contract_violations(tables["users"], tables["associates"], tables["logs"]))
    assert read_columns(text).count("FriendRel,PersonA_ID,PersonB_ID") == 1
    assert sum("PersonA_ID" in c for c in read_columns(text)) == 1


@pytest.fixture
def stored(spark, tables):
    names = {"users": "layout_users", "nations": "layout_nations"}
    layouts.store_bucketed(tables["users"], names["users"], "ID", 12)
    layouts.store_by_nationality(tables["users"], names["nations"])
    yield names
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize(
    "question",
    [
        lambda users, friends: ops.relationship_counts(users, friends),
        lambda users, friends: ops.owner_degree_profiles(friends, users),
        lambda users, friends: ops.popularity_labels(friends, users=users),
    ],
    ids=["D", "H2", "H3"],
)
def test_bucketed_users_are_not_shuffled(spark, tables, stored, rows, question):
    df = question(spark.table(stored["users"]), tables["associates"])
    text = plan(df)
    assert "Bucketed: true" in text
    users_id = re.search(r"FileScan parquet \S*layout_users\[(ID#\d+)L", text).group(1)
    assert "Exchange" in text and f"Exchange hashpartitioning({users_id}" not in text
    assert rows(df) == rows(question(tables["users"], tables["associates"]))


def test_friendships_of_users_in_buckets_need_no_exchange_at_all(spark, tables, rows):
    layouts.store_bucketed(tables["users"], "layout_people", "ID", 8)
    layouts.store_bucketed(tables["associates"], "layout_owners", "PersonA_ID", 8)
    try:
        df = ops.owner_degree_profiles(spark.table("layout_owners"), spark.table("layout_people"))
        assert "Exchange" not in plan(df)
        assert rows(df) == rows(ops.owner_degree_profiles(tables["associates"], tables["users"]))
    finally:
        spark.sql("DROP TABLE layout_people")
        spark.sql("DROP TABLE layout_owners")


@pytest.mark.parametrize("ignore_case", [False, True])
def test_other_nations_are_not_read(spark, tables, stored, rows, ignore_case):
    asked = "iNDIA" if ignore_case else "India"
    df = ops.users_by_nationality(layouts.users_of(spark, stored["nations"], asked, ignore_case), asked, ignore_case)
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(df)).group(1)
    assert "nation#" in filters
    files = df.inputFiles()
    everywhere = spark.table(stored["nations"]).inputFiles()
    assert rows(df) == rows(ops.users_by_nationality(tables["users"], asked, ignore_case)) and rows(df)
    # One folder, of those there are, is listed for the scan.
    df.collect()
    scans = df._jdf.queryExecution().executedPlan().collectLeaves()
    assert scans.size() == 1 and scans.head().metrics().get("numFiles").get().value() < len(everywhere)
    assert files


def test_empty_and_missing_nationalities_stay_apart(spark, rows):
    users = spark.createDataFrame([(1, "a", "", 1, "x"), (2, "b", None, 1, "x"), (3, "c", "007", 1, "x")], "ID long, Name string, Nationality string, CountryCod int, Hobby string")
    layouts.store_by_nationality(users, "layout_empty")
    try:
        assert rows(spark.table("layout_empty").drop("nation")) == rows(users)
        for asked in ("", "007", "7"):
            got = ops.users_by_nationality(layouts.users_of(spark, "layout_empty", asked), asked)
            assert rows(got) == rows(ops.users_by_nationality(users, asked))
    finally:
        spark.sql("DROP TABLE layout_empty")
