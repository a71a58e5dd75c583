"""Synthetic tables of any size.

Every value is a hash of the row number and a seed, so a row is the same on
every run, in every partitioning and after every retry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the data format.
HOBBIES = [
    "Reading", "Swimming", "Traveling", "Numismatics", "Boxing", "Photography",
    "Day Dreaming", "Watching Movies & Anime", "Playing Football",
]
RELATIONS = [
    "Fiance", "Best Friend", "Professor", "Colleague", "College-Friend", "Family",
    "Friend", "Other",
]
ACCESS_TYPES = [
    "Poked", "Viewed", "Wrote on Timeline", "Sent a Message", "Added a Friendship", "Other",
]
N_USERS = 200_000
N_ASSOCIATES = 20_000_000
N_ACCESS_LOGS = 10_000_000
MAX_TIME = 1_000_000
MAX_COUNTRY_CODE = 50

NATIONALITIES = [
    "Argentina", "Australia", "Austria", "Bangladesh", "Belgium", "Bolivia", "Brazil",
    "Canada", "Chile", "China", "Colombia", "Cuba", "Denmark", "Egypt", "Estonia", "Fiji",
    "Finland", "France", "Germany", "Ghana", "Greece", "Iceland", "India", "Indonesia",
    "Ireland", "Italy", "Japan", "Kenya", "Mexico", "Nepal", "New Zealand", "Norway", "Peru",
    "Poland", "Portugal", "Spain", "Sweden", "Turkey", "Uruguay", "Yemen",
]
FIRST_NAMES = [
    "Ada", "Ben", "Chloe", "Dan", "Elif", "Femi", "Grace", "Hugo", "Ines", "Jun",
    "Kofi", "Lena", "Mara", "Noor", "Omar", "Pia", "Quinn", "Ravi", "Sana", "Tom",
]
LAST_NAMES = [
    "Abbott", "Baker", "Castro", "Dietrich", "Evans", "Farouk", "Garcia", "Hansen",
    "Ito", "Jensen", "Kumar", "Lopez", "Moreau", "Novak", "Okafor", "Petrov",
    "Rossi", "Silva", "Tanaka", "Weber",
]


def _draw(row: str, salt: str, seed: int, size: int) -> Column:
    """Evenly from 1 to ``size``."""
    return F.pmod(F.xxhash64(F.col(row), F.lit(salt), F.lit(seed)), F.lit(size)) + 1


def _pick(row: str, salt: str, seed: int, values: list[str]) -> Column:
    index = _draw(row, salt, seed, len(values)).cast("int")
    return F.element_at(F.array(*map(F.lit, values)), index)


def generate_users(
    spark: SparkSession,
    n: int = N_USERS,
    nationalities: list[str] = NATIONALITIES,
    seed: int = 0,
) -> DataFrame:
    return spark.range(1, n + 1).select(
        F.col("id").alias("ID"),
        F.concat_ws(
            " ", _pick("id", "first", seed, FIRST_NAMES), _pick("id", "last", seed, LAST_NAMES)
        ).alias("Name"),
        _pick("id", "nationality", seed, nationalities).alias("Nationality"),
        _draw("id", "code", seed, MAX_COUNTRY_CODE).cast("int").alias("CountryCod"),
        _pick("id", "hobby", seed, HOBBIES).alias("Hobby"),
    )


def _rows_before(owner: str, n: int) -> str:
    """Pairs of all owners before ``owner``, as SQL. The product may go beyond 64 bits, the pairs
    themselves are row numbers and do not."""
    return f"((cast({owner} - 1 AS decimal(19, 0)) * cast(2 * {n}L - ({owner}) AS decimal(19, 0))) div 2)"


def associates_rows(numbers: DataFrame, n_users: int, seed: int = 0) -> DataFrame:
    """The friendship of every ``FriendRel``, where all pairs A < B are numbered in order.

    Owner ``i`` starts after ``(i - 1) * (2 * n - i) / 2`` rows; solving that for
    ``i`` gives the owner to within one, and whole-number comparisons settle it.
    """
    n = n_users
    edge = f"cast(2 * {n}L - 1 AS decimal(19, 0))"
    root = f"sqrt(cast({edge} * {edge} - 8 * cast(FriendRel - 1 AS decimal(20, 0)) AS double))"
    guess = numbers.withColumn("owner", F.expr(f"cast(floor((2 * {n}L + 1 - {root}) / 2) as bigint)"))
    settled = guess.select(
        "FriendRel",
        F.expr(f"""
            CASE WHEN FriendRel <= {_rows_before("owner", n)} THEN owner - 1
                 WHEN FriendRel > {_rows_before("owner + 1", n)} THEN owner + 1
                 ELSE owner END
        """).alias("PersonA_ID"),
    )
    return settled.select(
        "FriendRel",
        "PersonA_ID",
        F.expr(f"PersonA_ID + FriendRel - {_rows_before('PersonA_ID', n)}").alias("PersonB_ID"),
        _draw("FriendRel", "date", seed, MAX_TIME).cast("int").alias("DateofFriendship"),
        _pick("FriendRel", "relation", seed, RELATIONS).alias("Desc"),
    )


def generate_associates(
    spark: SparkSession, n_users: int = N_USERS, max_rel: int = N_ASSOCIATES, seed: int = 0
) -> DataFrame:
    """All pairs A < B in order, cut after ``max_rel``; FriendRel is the running number.

    Each row is worked out from its number alone: no self join, and equal tasks
    although the first owners have nearly all friendships.
    """
    rows = min(max_rel, n_users * (n_users - 1) // 2)
    return associates_rows(spark.range(1, rows + 1).toDF("FriendRel"), n_users, seed)


def access_log_rows(numbers: DataFrame, n_users: int, seed: int = 0) -> DataFrame:
    """The access of every ``AccessId``: visitor, page, type and time, all evenly spread."""
    return numbers.select(
        "AccessId",
        _draw("AccessId", "visitor", seed, n_users).alias("ByWho"),
        _draw("AccessId", "page", seed, n_users).alias("WhatPage"),
        _pick("AccessId", "type", seed, ACCESS_TYPES).alias("TypeOfAccess"),
        _draw("AccessId", "time", seed, MAX_TIME).alias("AccessTime"),
    )


def generate_access_logs(
    spark: SparkSession, n: int = N_ACCESS_LOGS, n_users: int = N_USERS, seed: int = 0
) -> DataFrame:
    return access_log_rows(spark.range(1, n + 1).toDF("AccessId"), n_users, seed)
