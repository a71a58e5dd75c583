"""Tables stored so that later questions need not shuffle or read all of them.

They are tables of the session's catalog, in its warehouse. A store costs one shuffle and one
write, which pay off from the second question on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amity.functions import equals_ignore_case

#: The partition column of ``store_by_nationality``.
NATION = "nation"


def store_bucketed(df: DataFrame, name: str, key: str, buckets: int, mode: str = "errorifexists") -> DataFrame:
    """``df`` as a table of one file for each hash bucket of ``key``.

    A join or grouping on ``key`` takes the buckets as they are: this side needs no exchange, and
    what it is joined with is shuffled into as many partitions. So profiles join
    counts with only the counts, one row an id, going through the network. ``buckets`` is for
    the whole table's size, as a bucket is one task's work: 100 to 200 MB each.

    For tables whose keys are spread, as unique ids are. All rows of one key are in one bucket, so
    friendships, which may have an owner with a third of them, are better grouped as they are.
    """
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode(mode).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def store_by_nationality(users: DataFrame, name: str, mode: str = "errorifexists") -> DataFrame:
    """The users as a table with a folder for each nationality.

    The folder is named by a column of its own, ``nation``, which is NULL for missing and empty
    nationalities alike, as folders can't tell them apart; ``Nationality`` itself stays in the files.
    Rows are dealt by nation, where large ones are split and small ones put together by size.
    """
    nation = F.when(F.col("Nationality") != "", F.col("Nationality")).alias(NATION)
    dealt = users.select("*", nation).hint("rebalance", F.col(NATION))
    dealt.write.partitionBy(NATION).mode(mode).format("parquet").saveAsTable(name)
    return users.sparkSession.table(name)


def users_of(spark: SparkSession, name: str, nationality: str, ignore_case: bool = False) -> DataFrame:
    """The users of such a table who may be of a nationality; no other nation's file is read.

    With ``ignore_case`` the folders' names are compared as ``users_by_nationality`` compares
    values, before any file is opened.
    """
    users = spark.table(name)
    if not nationality:
        return users.where(F.col(NATION).isNull()).drop(NATION)
    match = equals_ignore_case(F.col(NATION), nationality) if ignore_case else F.col(NATION) == nationality
    return users.where(match).drop(NATION)
