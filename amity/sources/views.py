"""The three tables as views over a star schema of parquet files.

The `*_SQL` texts define the same views for another SQL engine; they are what
the queries are checked against.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amity import sinks

# Known schemas spare every read the job that would look one up in a file.
SCHEMAS = {
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string,
        o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# Customers with their nation. The 25 nations are broadcast by their file size.
USERS_SQL = """
    SELECT c_custkey AS "ID", c_name AS "Name", n_name AS "Nationality",
           c_nationkey AS "CountryCod", c_mktsegment AS "Hobby"
    FROM customer JOIN nation ON c_nationkey = n_nationkey
"""


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("ID"),
        F.col("c_name").alias("Name"),
        F.col("n_name").alias("Nationality"),
        F.col("c_nationkey").alias("CountryCod"),
        F.col("c_mktsegment").alias("Hobby"),
    )


# Order lines: an order is tied to the supplier of each of its lines. Owners range
# from none to many friendships, ids reach beyond the users, FriendRel repeats,
# and some pairs are equal or stored both ways.
ASSOCIATES_SQL = """
    SELECT l_orderkey * 8 + l_linenumber AS "FriendRel", l_orderkey AS "PersonA_ID",
           l_suppkey AS "PersonB_ID", l_shipdate AS "DateofFriendship", l_returnflag AS "Desc"
    FROM lineitem
"""


def associates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("FriendRel"),
        F.col("l_orderkey").alias("PersonA_ID"),
        F.col("l_suppkey").alias("PersonB_ID"),
        F.col("l_shipdate").alias("DateofFriendship"),
        F.col("l_returnflag").alias("Desc"),
    )


# A dense graph: every customer tied to the suppliers of everything ordered.
CUSTOMER_ASSOCIATES_SQL = """
    SELECT o_custkey AS "PersonA_ID", l_suppkey AS "PersonB_ID",
           o_orderdate AS "DateofFriendship", o_orderpriority AS "Desc"
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def customer_associates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("PersonA_ID"),
        F.col("l_suppkey").alias("PersonB_ID"),
        F.col("o_orderdate").alias("DateofFriendship"),
        F.col("o_orderpriority").alias("Desc"),
    )


# Events; the page is a member of a JSON text.
ACCESS_LOGS_SQL = """
    SELECT event_id AS "AccessId", user_id AS "ByWho",
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS "WhatPage",
           event_type AS "TypeOfAccess", ts AS "AccessTime"
    FROM events
"""


def access_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("AccessId"),
        F.col("user_id").alias("ByWho"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("WhatPage"),
        F.col("event_type").alias("TypeOfAccess"),
        F.col("ts").alias("AccessTime"),
    )


# The same accesses with the time as a number.
ACCESS_LOGS_MILLIS_SQL = ACCESS_LOGS_SQL.replace(
    'ts AS "AccessTime"', 'epoch_us(ts) // 1000 AS "AccessTime"'
)
ACCESS_LOGS_MINUTES_SQL = ACCESS_LOGS_SQL.replace(
    'ts AS "AccessTime"', 'CAST(floor(epoch(ts) / 60) AS BIGINT) AS "AccessTime"'
)


def _since_1970(factor: str) -> Column:
    """Whole units since 1970, with no zone involved."""
    return F.expr(
        "cast(floor(cast(cast(AccessTime - timestamp_ntz'1970-01-01 00:00:00'"
        f" as interval second) as decimal(18, 6)) {factor}) as bigint)"
    )


def access_logs_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access_logs(spark, sf_dir).withColumn("AccessTime", _since_1970("* 1000"))


def access_logs_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access_logs(spark, sf_dir).withColumn("AccessTime", _since_1970("/ 60"))


# Order lines as visits of parts by suppliers: a page id is often no user.
PART_VISITS_SQL = """
    SELECT l_orderkey * 8 + l_linenumber AS "AccessId", l_suppkey AS "ByWho",
           l_partkey AS "WhatPage", l_returnflag AS "TypeOfAccess", l_shipdate AS "AccessTime"
    FROM lineitem
"""


def part_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("AccessId"),
        F.col("l_suppkey").alias("ByWho"),
        F.col("l_partkey").alias("WhatPage"),
        F.col("l_returnflag").alias("TypeOfAccess"),
        F.col("l_shipdate").alias("AccessTime"),
    )


# Orders as accesses by customers.
ORDER_ACCESSES_SQL = """
    SELECT o_orderkey AS "AccessId", o_custkey AS "ByWho", o_orderdate AS "AccessTime" FROM orders
"""


def order_accesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("AccessId"),
        F.col("o_custkey").alias("ByWho"),
        F.col("o_orderdate").alias("AccessTime"),
    )


# Lines of text of very different shapes: accesses with a readable time, and the
# lines of all documents, cut at commas.
RAW_LINES_SQL = f"""
    SELECT coalesce("AccessId"::VARCHAR, '') || ',' || coalesce("ByWho"::VARCHAR, '') || ','
           || coalesce("WhatPage"::VARCHAR, '') || ',' || coalesce("TypeOfAccess", '') || ','
           || coalesce("AccessTime"::VARCHAR, '') AS value
    FROM ({ACCESS_LOGS_MILLIS_SQL})
    UNION ALL
    SELECT unnest(string_split(text, chr(10))) AS value FROM documents
"""


def access_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.lines(access_logs_millis(spark, sf_dir), sep=",")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.explode(F.split("text", "\n"))
    return table(spark, sf_dir, "documents").select(lines.alias("value"))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access_lines(spark, sf_dir).unionByName(document_lines(spark, sf_dir))


def merged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Friendships as lines of three fields among accesses as lines of five."""
    friends = associates(spark, sf_dir).select("FriendRel", "PersonA_ID", "PersonB_ID")
    return sinks.lines(friends, sep=",").unionByName(access_lines(spark, sf_dir))


def dated_associates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Friendships with the date as a number of days."""
    day = F.unix_date(F.col("DateofFriendship").cast("date"))
    return associates(spark, sf_dir).withColumn("DateofFriendship", day)


def merged_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole friendships and accesses, both lines of five fields, with the name of their file."""
    file = F.col("_metadata.file_name")
    folder = "element_at(split(_metadata.file_path, '/'), -2)"
    # A table that is a folder gives its files other names.
    of = F.when(F.expr(folder).endswith(".parquet"), F.expr(folder)).otherwise(file).alias("file")

    def named(table: DataFrame) -> DataFrame:
        columns = table.columns
        fields = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns])
        return table.select(fields.alias("value"), of)

    return named(dated_associates(spark, sf_dir)).unionByName(named(access_logs_millis(spark, sf_dir)))


# Users as lines whose names hold a comma and quotes.
def quoted_user_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    doubled = F.concat(F.lit('"'), F.col("Name"), F.lit(', ""'), F.col("Hobby"), F.lit('"""'))
    return sinks.lines(users(spark, sf_dir).withColumn("Name", doubled), sep=",")


# Lines of documents whose first field opens a quote, which mostly is not closed.
OPENED_LINES_SQL = """
    SELECT '"' || line AS value
    FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
    WHERE NOT contains(line, '"')
"""


def opened_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = document_lines(spark, sf_dir).where(~F.contains("value", F.lit('"')))
    return lines.select(F.concat(F.lit('"'), "value").alias("value"))
