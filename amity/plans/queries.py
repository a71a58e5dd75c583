"""Every operator as a named query over the star-schema tables, with its check in SQL.

A query reads its tables whole. The SQL is written from the question, not from
the Spark code, and uses the same view definitions.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from amity import layouts, sinks, sources
from amity import operators as ops
from amity.functions import field_count, minutes_cutoff, split_fields
from amity.operators.friends import NEVER_ACCESSED_PAGE, SIEVE_BITS
from amity.schemas import ACCESS_LOGS, ASSOCIATES, USERS
from amity.sources import views as v

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

_VIEWS = {
    "users": v.USERS_SQL,
    "associates": v.ASSOCIATES_SQL,
    "customer_associates": v.CUSTOMER_ASSOCIATES_SQL,
    "access_logs": v.ACCESS_LOGS_SQL,
    "access_logs_millis": v.ACCESS_LOGS_MILLIS_SQL,
    "access_logs_minutes": v.ACCESS_LOGS_MINUTES_SQL,
    "part_visits": v.PART_VISITS_SQL,
    "order_accesses": v.ORDER_ACCESSES_SQL,
    "raw_lines": v.RAW_LINES_SQL,
    "opened_lines": v.OPENED_LINES_SQL,
}


def _register(name: str, query: Query, sql: str) -> None:
    used = [f"{view} AS ({text})" for view, text in _VIEWS.items() if f"{{{view}}}" in sql]
    body = sql
    for view in _VIEWS:
        body = body.replace(f"{{{view}}}", view)
    QUERIES[name] = query
    SQL[name] = f"WITH {', '.join(used)} {body}" if used else body


# Users

_register(
    "users_by_nationality",
    lambda s, d: ops.users_by_nationality(v.users(s, d), "NATION_7"),
    """SELECT "Name", "Hobby" FROM {users} WHERE "Nationality" = 'NATION_7'""",
)
_register(
    "users_by_nationality_ignore_case",
    lambda s, d: ops.users_by_nationality(v.users(s, d), "nation_7", ignore_case=True),
    """SELECT "Name", "Hobby" FROM {users} WHERE lower("Nationality") = 'nation_7'""",
)
_register(
    "users_per_nationality",
    lambda s, d: ops.users_per_nationality(v.users(s, d)),
    """SELECT "Nationality", count(*) AS n FROM {users} GROUP BY "Nationality" """,
)
_register(
    "users_per_country_code",
    lambda s, d: ops.users_per_country_code(v.users(s, d)),
    """SELECT "CountryCod", count(*) AS n FROM {users} GROUP BY "CountryCod" """,
)

# Accesses

_register(
    "visits_per_page",
    lambda s, d: ops.visits_per_page(v.access_logs(s, d)),
    """SELECT "WhatPage", count(*) AS n FROM {access_logs} GROUP BY "WhatPage" """,
)


def _top_pages_sql(logs: str, k: int) -> str:
    return f"""
    SELECT "WhatPage", coalesce("Name", 'Unknown') AS "Name",
           coalesce("Nationality", 'Unknown') AS "Nationality", n
    FROM (SELECT "WhatPage", count(*) AS n FROM {logs} GROUP BY "WhatPage"
          ORDER BY n DESC, "WhatPage" LIMIT {k})
    LEFT JOIN {{users}} ON "WhatPage" = "ID"
    """


_register(
    "top_pages",
    lambda s, d: ops.top_pages(v.access_logs(s, d), v.users(s, d)),
    _top_pages_sql("{access_logs}", 10),
)
_register(
    "top_pages_without_count",
    lambda s, d: ops.top_pages(v.access_logs(s, d), v.users(s, d), with_count=False),
    f"""SELECT "WhatPage", "Name", "Nationality" FROM ({_top_pages_sql("{access_logs}", 10)})""",
)
_register(
    "top_pages_unknown_owners",
    lambda s, d: ops.top_pages(v.part_visits(s, d), v.users(s, d), k=50),
    _top_pages_sql("{part_visits}", 50),
)
_register(
    "access_stats",
    lambda s, d: ops.access_stats(v.access_logs(s, d)),
    """SELECT "ByWho", count(*) AS total, count(DISTINCT "WhatPage") AS distinct_pages
       FROM {access_logs} GROUP BY "ByWho" """,
)
_register(
    "access_stats_part_visits",
    lambda s, d: ops.access_stats(v.part_visits(s, d), order_key="numeric"),
    """SELECT "ByWho", count(*) AS total, count(DISTINCT "WhatPage") AS distinct_pages
       FROM {part_visits} GROUP BY "ByWho" """,
)
_register(
    "access_stats_formatted",
    lambda s, d: ops.access_stats(v.access_logs(s, d), formatted=True, order_key="text"),
    """SELECT "ByWho", 'TotalAccesses: ' || count(*) || ', DistinctPages: '
              || count(DISTINCT "WhatPage") AS summary
       FROM {access_logs} GROUP BY "ByWho" """,
)



def _rolled_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of bitmaps for each kind of visit, as of days, then all of them together."""
    visits = v.part_visits(spark, sf_dir)
    kinds = [F.col("TypeOfAccess") == "A", F.col("TypeOfAccess") == "N"]
    kinds.append(~F.coalesce(kinds[0] | kinds[1], F.lit(False)))
    return ops.merged_access_stats(*[ops.page_bitmaps(visits.where(k)) for k in kinds])


_register(
    "access_stats_rolled_up",
    _rolled_up,
    """SELECT "ByWho", count(*) AS total, count(DISTINCT "WhatPage") AS distinct_pages
       FROM {part_visits} GROUP BY "ByWho" """,
)
_register(
    "page_bitmaps",
    lambda s, d: ops.page_bitmaps(v.access_logs(s, d)),
    """SELECT "ByWho", "WhatPage" // 64 AS word, count(*) AS visits, bit_or(CASE "WhatPage" % 64 WHEN 63 THEN (-9223372036854775808)::BIGINT ELSE 1::BIGINT << ("WhatPage" % 64) END) AS pages
       FROM (SELECT "ByWho", "WhatPage" FROM {access_logs}) GROUP BY 1, 2""",
)

# Friendships

_RELATIONSHIP_COUNTS = """
    SELECT "ID", any_value("Name") AS "Name", count(person) AS n
    FROM {users} LEFT JOIN (SELECT "PersonA_ID" AS person FROM {graph}
                            UNION ALL SELECT "PersonB_ID" FROM {graph}) ON "ID" = person
    GROUP BY "ID"
"""
_UNVISITED_PAIRS = """
    SELECT DISTINCT "PersonA_ID", "PersonB_ID" FROM {graph} a
    WHERE NOT EXISTS (SELECT 1 FROM {access_logs} l
                      WHERE l."ByWho" = a."PersonA_ID" AND l."WhatPage" = a."PersonB_ID")
"""
_UNVISITED_OWNERS = _UNVISITED_PAIRS.replace(', "PersonB_ID" FROM', " FROM")
_VISITING_NONE = """
    SELECT DISTINCT "PersonA_ID" FROM {graph}
    EXCEPT
    SELECT a."PersonA_ID" FROM {graph} a JOIN {access_logs} l
      ON l."ByWho" = a."PersonA_ID" AND l."WhatPage" = a."PersonB_ID"
"""

for _suffix, _view, _graph in [
    ("", v.associates, "{associates}"),
    ("_customers", v.customer_associates, "{customer_associates}"),
]:
    _register(
        f"relationship_counts{_suffix}",
        lambda s, d, g=_view: ops.relationship_counts(v.users(s, d), g(s, d)),
        _RELATIONSHIP_COUNTS.replace("{graph}", _graph),
    )
    _register(
        f"unvisited_friend_pairs{_suffix}",
        lambda s, d, g=_view: ops.unvisited_friend_pairs(g(s, d), v.access_logs(s, d)),
        _UNVISITED_PAIRS.replace("{graph}", _graph),
    )
    _register(
        f"owners_with_unvisited_friend{_suffix}",
        lambda s, d, g=_view: ops.owners_with_unvisited_friend(g(s, d), v.access_logs(s, d)),
        _UNVISITED_OWNERS.replace("{graph}", _graph),
    )
    _register(
        f"owners_visiting_no_friend{_suffix}",
        lambda s, d, g=_view: ops.owners_visiting_no_friend(g(s, d), v.access_logs(s, d)),
        _VISITING_NONE.replace("{graph}", _graph),
    )
    _register(
        f"unvisited_friend_pairs_sieved{_suffix}",
        lambda s, d, g=_view: ops.unvisited_friend_pairs(g(s, d), v.access_logs(s, d), SIEVE_BITS),
        _UNVISITED_PAIRS.replace("{graph}", _graph),
    )
    _register(
        f"owners_visiting_no_friend_sieved{_suffix}",
        lambda s, d, g=_view: ops.owners_visiting_no_friend(g(s, d), v.access_logs(s, d), SIEVE_BITS),
        _VISITING_NONE.replace("{graph}", _graph),
    )
    _register(
        f"owner_degree_profiles{_suffix}",
        lambda s, d, g=_view: ops.owner_degree_profiles(g(s, d), v.users(s, d)),
        """
    SELECT * FROM (SELECT "PersonA_ID", count(*) AS n FROM {graph} GROUP BY "PersonA_ID")
    JOIN {users} ON "PersonA_ID" = "ID"
        """.replace("{graph}", _graph),
    )

# Users as stored tables. The stores are written anew, under names of their own.


def _store(spark: SparkSession, sf_dir: str, store: Callable[[DataFrame, str], DataFrame]) -> str:
    name = f"amity_users_{uuid4().hex}"
    store(v.users(spark, sf_dir), name)
    return name


def _bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.table(_store(spark, sf_dir, lambda df, name: layouts.store_bucketed(df, name, "ID", buckets)))


_register(
    "relationship_counts_bucketed",
    lambda s, d: ops.relationship_counts(_bucketed(s, d), v.associates(s, d)),
    _RELATIONSHIP_COUNTS.replace("{graph}", "{associates}"),
)
_register(
    "popularity_labels_bucketed",
    lambda s, d: ops.popularity_labels(v.associates(s, d), users=_bucketed(s, d)),
    """SELECT "ID" AS owner,
              CASE WHEN count("PersonA_ID") > 1 THEN 'More Popular'
                   ELSE 'Not More Popular' END AS label
       FROM {users} LEFT JOIN {associates} ON "ID" = "PersonA_ID" GROUP BY "ID" """,
)


def _of_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _store(spark, sf_dir, layouts.store_by_nationality)
    return ops.users_by_nationality(layouts.users_of(spark, stored, "nation_7", True), "nation_7", ignore_case=True)


_register(
    "users_by_nationality_partitioned",
    _of_nation,
    """SELECT "Name", "Hobby" FROM {users} WHERE lower("Nationality") = 'nation_7'""",
)

# Popularity

_register(
    "owner_degrees",
    lambda s, d: ops.owner_degrees(v.associates(s, d)),
    """SELECT "PersonA_ID", count(*) AS n FROM {associates} GROUP BY "PersonA_ID" """,
)
_register(
    "popularity_labels",
    lambda s, d: ops.popularity_labels(v.associates(s, d)),
    """SELECT "PersonA_ID" AS owner,
              CASE WHEN count(*) > 1 THEN 'More Popular' ELSE 'Not More Popular' END AS label
       FROM {associates} GROUP BY "PersonA_ID" """,
)
_register(
    "popularity_labels_all_users",
    lambda s, d: ops.popularity_labels(v.associates(s, d), users=v.users(s, d)),
    """SELECT "ID" AS owner,
              CASE WHEN count("PersonA_ID") > 1 THEN 'More Popular'
                   ELSE 'Not More Popular' END AS label
       FROM {users} LEFT JOIN {associates} ON "ID" = "PersonA_ID" GROUP BY "ID" """,
)

# Activity

_register(
    "latest_access",
    lambda s, d: ops.latest_access(v.access_logs(s, d)),
    """SELECT "ByWho", max("AccessTime") AS last FROM {access_logs} GROUP BY "ByWho" """,
)
_register(
    "inactive_users",
    lambda s, d: ops.inactive_users(v.access_logs(s, d), "2024-01-31", timedelta(hours=12)),
    """SELECT "ByWho" FROM {access_logs} GROUP BY "ByWho"
       HAVING TIMESTAMP '2024-01-31' - max("AccessTime") > INTERVAL 12 HOUR""",
)
_register(
    "inactive_users_orders",
    lambda s, d: ops.inactive_users(v.order_accesses(s, d), "2001-08-01", timedelta(days=90)),
    """SELECT "ByWho" FROM {order_accesses} GROUP BY "ByWho"
       HAVING TIMESTAMP '2001-08-01' - max("AccessTime") > INTERVAL 90 DAY""",
)
# 2024-01-31 in milliseconds, and half a day.
_AS_OF, _HALF_DAY = 1_706_659_200_000, 12 * 60 * 60 * 1000
_INACTIVE_MILLIS = f"""
    SELECT "ByWho" FROM {{access_logs_millis}} GROUP BY "ByWho"
    HAVING {_AS_OF} - greatest(max("AccessTime"), 0) > {_HALF_DAY}
"""
_register(
    "inactive_users_millis",
    lambda s, d: ops.inactive_users(v.access_logs_millis(s, d), _AS_OF, _HALF_DAY),
    _INACTIVE_MILLIS,
)
_CUTOFF = minutes_cutoff(_AS_OF / 1000, days=0.5)
_register(
    "inactive_users_minutes",
    lambda s, d: ops.inactive_users_minutes(v.access_logs_minutes(s, d), _CUTOFF),
    f"""SELECT "ByWho" FROM {{access_logs_minutes}} GROUP BY "ByWho"
        HAVING greatest(max("AccessTime"), 0) < ({_AS_OF} - {_HALF_DAY}) / 60000""",
)

# Data quality


def _row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.row_counts({
        "users": v.users(spark, sf_dir),
        "associates": v.associates(spark, sf_dir),
        "access_logs": v.access_logs(spark, sf_dir),
    })


_register(
    "row_counts",
    _row_counts,
    """SELECT 'users' AS "table", count(*) AS n FROM {users}
       UNION ALL SELECT 'associates', count(*) FROM {associates}
       UNION ALL SELECT 'access_logs', count(*) FROM {access_logs}""",
)
_register(
    "contract_violations",
    lambda s, d: ops.contract_violations(v.users(s, d), v.associates(s, d), v.access_logs(s, d)),
    """
    SELECT 'users.repeated_id' AS rule, count(*) AS n
      FROM (SELECT "ID" FROM {users} GROUP BY "ID" HAVING count(*) > 1)
    UNION ALL SELECT 'users.id_range', count(*)
      FROM {users} WHERE "ID" NOT BETWEEN 1 AND 200000
    UNION ALL SELECT 'users.country_code_range', count(*)
      FROM {users} WHERE "CountryCod" NOT BETWEEN 1 AND 50
    UNION ALL SELECT 'associates.repeated_id', count(*)
      FROM (SELECT "FriendRel" FROM {associates} GROUP BY "FriendRel" HAVING count(*) > 1)
    UNION ALL SELECT 'associates.person_range', count(*)
      FROM {associates} WHERE "PersonA_ID" NOT BETWEEN 1 AND 200000
                           OR "PersonB_ID" NOT BETWEEN 1 AND 200000
    UNION ALL SELECT 'associates.self_friend', count(*)
      FROM {associates} WHERE "PersonA_ID" = "PersonB_ID"
    UNION ALL SELECT 'associates.reciprocal', count(*)
      FROM (SELECT DISTINCT "PersonA_ID" a, "PersonB_ID" b FROM {associates})
      WHERE a < b AND (b, a) IN (SELECT ("PersonA_ID", "PersonB_ID") FROM {associates})
    UNION ALL SELECT 'access_logs.repeated_id', count(*)
      FROM (SELECT "AccessId" FROM {access_logs} GROUP BY "AccessId" HAVING count(*) > 1)
    UNION ALL SELECT 'access_logs.person_range', count(*)
      FROM {access_logs} WHERE "ByWho" NOT BETWEEN 1 AND 200000
                            OR "WhatPage" NOT BETWEEN 1 AND 200000
    """,
)
_N_FIELDS = "len(string_split(rtrim(value, ','), ','))"


_BLANKS_SQL = "(SELECT string_agg(chr(c::INT), '') FROM range(1, 33) t(c))"


def _field_sql(i: int) -> str:
    return f"trim(string_split(rtrim(value, ','), ',')[{i}], {_BLANKS_SQL})"


def _long_sql(i: int) -> str:
    field = _field_sql(i)
    return f"CASE WHEN regexp_full_match({field}, '[+-]?[0-9]+') THEN TRY_CAST({field} AS BIGINT) END"


_register(
    "record_quality",
    lambda s, d: ops.record_quality(sources.raw_from_lines(v.raw_lines(s, d), ACCESS_LOGS)),
    f"""
    SELECT count(*) AS rows, count(*) FILTER ({_N_FIELDS} <> 5) AS wrong_arity,
           count(*) FILTER ({_N_FIELDS} = 5 AND ({_long_sql(5)}) IS NULL) AS invalid_time
    FROM {{raw_lines}}
    """,
)

_FIRST_BAD = " ".join(f"WHEN ({_long_sql(i)}) IS NULL THEN '{c}'" for i, c in [(1, "AccessId"), (2, "ByWho"), (3, "WhatPage"), (5, "AccessTime")])
_REASON = f"CASE WHEN {_N_FIELDS} <> 5 THEN 'wrong number of fields' {_FIRST_BAD} END"
_register(
    "rejected_records",
    lambda s, d: ops.rejected_records(v.raw_lines(s, d), ACCESS_LOGS, sources.EXACTLY_5),
    f"""SELECT value AS line, CAST({_N_FIELDS} AS INTEGER) AS n_fields, {_REASON} AS reason
        FROM {{raw_lines}} WHERE {_REASON} IS NOT NULL""",
)
_register(
    "accepted_records",
    lambda s, d: ops.routed_records(v.raw_lines(s, d), ACCESS_LOGS, sources.EXACTLY_5)
    .where("reason IS NULL")
    .select("record.*"),
    f"""SELECT {_long_sql(1)} AS "AccessId", {_long_sql(2)} AS "ByWho", {_long_sql(3)} AS "WhatPage",
               {_field_sql(4)} AS "TypeOfAccess", {_long_sql(5)} AS "AccessTime"
        FROM {{raw_lines}} WHERE {_REASON} IS NULL""",
)
_register(
    "access_stats_observed",
    lambda s, d: ops.access_stats(
        sources.typed(
            ops.observed_quality(sources.raw_from_lines(v.raw_lines(s, d), ACCESS_LOGS))[0], ACCESS_LOGS, sources.EXACTLY_5
        )
    ),
    f"""SELECT {_long_sql(2)} AS "ByWho", count(*) AS total, count(DISTINCT {_long_sql(3)}) AS distinct_pages
        FROM {{raw_lines}} WHERE {_N_FIELDS} = 5 AND ({_long_sql(2)}) IS NOT NULL GROUP BY 1""",
)

# Delimited text in


def _split_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("value")
    return v.raw_lines(spark, sf_dir).select(
        field_count(line).alias("n_fields"),
        F.get(split_fields(line, 2), F.lit(0)).alias("first"),
        F.get(split_fields(line, 2), F.lit(1)).alias("rest"),
    )


_register(
    "split_fields",
    _split_fields,
    f"""SELECT CAST({_N_FIELDS} AS INTEGER) AS n_fields, split_part(value, ',', 1) AS first,
               CASE WHEN contains(value, ',') THEN substr(value, strpos(value, ',') + 1) END AS rest
        FROM {{raw_lines}}""",
)
_register(
    "typed_access_lines",
    lambda s, d: sources.typed(
        sources.raw_from_lines(v.raw_lines(s, d), ACCESS_LOGS), ACCESS_LOGS, sources.AT_LEAST_5
    ),
    f"""SELECT {_long_sql(1)} AS "AccessId", {_long_sql(2)} AS "ByWho",
               {_long_sql(3)} AS "WhatPage", {_field_sql(4)} AS "TypeOfAccess",
               {_long_sql(5)} AS "AccessTime"
        FROM {{raw_lines}} WHERE {_N_FIELDS} >= 5""",
)


def _split_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.split_merged(v.merged_lines(spark, sf_dir)).select(
        "kind",
        F.coalesce("friendship.PersonA_ID", "access.ByWho").alias("person"),
        F.coalesce("friendship.PersonB_ID", "access.WhatPage").alias("page"),
    )


_register(
    "split_merged",
    _split_merged,
    """SELECT 'friendship' AS kind, "PersonA_ID" AS person, "PersonB_ID" AS page FROM {associates}
       UNION ALL SELECT 'access', "ByWho", "WhatPage" FROM {access_logs}""",
)
_register(
    "owners_visiting_no_friend_merged",
    lambda s, d: ops.owners_visiting_no_friend_merged(v.merged_lines(s, d)),
    _VISITING_NONE.replace("{graph}", "{associates}"),
)

# Whole friendships among accesses, told apart by the file that a line is from.
def _of_friends() -> Column:
    return F.col("file").startswith("lineitem")


def _split_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.split_merged(v.merged_file_lines(spark, sf_dir), _of_friends()).select("kind", "friendship.*", "access.*")


_register(
    "split_merged_by_file",
    _split_by_file,
    """SELECT 'friendship' AS kind, "FriendRel", "PersonA_ID", "PersonB_ID",
              CAST(CAST("DateofFriendship" AS DATE) - DATE '1970-01-01' AS INTEGER) AS "DateofFriendship", "Desc",
              NULL::BIGINT AS "AccessId", NULL::BIGINT AS "ByWho", NULL::BIGINT AS "WhatPage",
              NULL::VARCHAR AS "TypeOfAccess", NULL::BIGINT AS "AccessTime" FROM {associates}
       UNION ALL SELECT 'access', NULL, NULL, NULL, NULL, NULL, * FROM {access_logs_millis}""",
)
_register(
    "owners_visiting_no_friend_by_file",
    lambda s, d: ops.owners_visiting_no_friend_merged(v.merged_file_lines(s, d), _of_friends()),
    _VISITING_NONE.replace("{graph}", "{associates}"),
)

# Tables as lines, through the readers' parser and types.


def _reread(table: Query, schema: StructType, fields: sources.Fields) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = sinks.lines(table(spark, sf_dir), sep=",")
        return sources.typed(sources.raw_from_lines(lines, schema), schema, fields)

    return query


_register("read_users", _reread(v.users, USERS, sources.AT_LEAST_5), "SELECT * FROM {users}")
_register(
    "read_associates",
    _reread(v.dated_associates, ASSOCIATES, sources.AT_LEAST_3),
    """SELECT * REPLACE (CAST(CAST("DateofFriendship" AS DATE) - DATE '1970-01-01' AS INTEGER)
                         AS "DateofFriendship") FROM {associates}""",
)
_register(
    "read_access_logs",
    _reread(v.access_logs_millis, ACCESS_LOGS, sources.AT_LEAST_3),
    "SELECT * FROM {access_logs_millis}",
)
_register(
    "read_quoted_users",
    lambda s, d: sources.typed(
        sources.raw_from_lines(v.quoted_user_lines(s, d), USERS), USERS, sources.EXACTLY_5
    ),
    """SELECT * REPLACE ("Name" || ', "' || "Hobby" || '"' AS "Name") FROM {users}""",
)
_register(
    "unclosed_quotes",
    lambda s, d: sources.raw_from_lines(v.opened_lines(s, d), ACCESS_LOGS).select("AccessId", "n_fields"),
    f"""SELECT string_split(rtrim(value, ','), ',')[1] AS "AccessId", CAST({_N_FIELDS} AS INTEGER) AS n_fields
        FROM {{opened_lines}}""",
)
_register(
    "access_stats_unreadable_pages",
    lambda s, d: ops.access_stats(
        sources.typed(sources.raw_from_lines(v.raw_lines(s, d), ACCESS_LOGS), ACCESS_LOGS, sources.Fields(2))
        .withColumn("ByWho", F.coalesce("ByWho", F.lit(-1)))
    ),
    f"""SELECT coalesce({_long_sql(2)}, -1) AS "ByWho", count(*) AS total,
               count(DISTINCT {_long_sql(3)}) AS distinct_pages
        FROM {{raw_lines}} WHERE {_N_FIELDS} >= 2 GROUP BY 1""",
)
_register(
    "relationship_lines",
    lambda s, d: sinks.lines(
        ops.relationship_counts(v.users(s, d), v.associates(s, d)).select("Name", "n"), sep=","
    ),
    _RELATIONSHIP_COUNTS.replace("{graph}", "{associates}").replace(
        """SELECT "ID", any_value("Name") AS "Name", count(person) AS n""",
        """SELECT any_value("Name") || ',' || count(person) AS value""",
    ),
)
_register(
    "inactive_user_lines",
    lambda s, d: sinks.lines(ops.inactive_users(v.access_logs_millis(s, d), _AS_OF, _HALF_DAY)),
    f"SELECT CAST(\"ByWho\" AS VARCHAR) AS value FROM ({_INACTIVE_MILLIS})",
)
_register(
    "top_page_lines",
    lambda s, d: sinks.lines(ops.top_pages(v.access_logs(s, d), v.users(s, d)), value_sep=","),
    f"""
    SELECT "WhatPage" || chr(9) || "Name" || ',' || "Nationality" || ',' || n AS value
    FROM ({_top_pages_sql("{access_logs}", 10)})
    """,
)
_register(
    "unvisited_friend_lines",
    lambda s, d: sinks.lines(
        ops.unvisited_friend_pairs(v.associates(s, d), v.access_logs(s, d)).select(
            "PersonA_ID", F.lit(NEVER_ACCESSED_PAGE)
        )
    ),
    f"""SELECT "PersonA_ID" || chr(9) || '{NEVER_ACCESSED_PAGE}' AS value
        FROM ({_UNVISITED_PAIRS.replace("{graph}", "{associates}")})""",
)
