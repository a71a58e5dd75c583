"""Questions on the user table alone. Filters need no shuffle, counts a small one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amity.functions import equals_ignore_case


def users_by_nationality(
    users: DataFrame, nationality: str = "India", ignore_case: bool = False
) -> DataFrame:
    """Name and hobby of every user of one nationality; equal rows are all kept."""
    if ignore_case:
        match = equals_ignore_case(F.col("Nationality"), nationality)
    else:
        match = F.col("Nationality") == nationality
    return users.where(match).select("Name", "Hobby")


def users_per_nationality(users: DataFrame) -> DataFrame:
    return users.groupBy("Nationality").agg(F.count("*").alias("n"))


def users_per_country_code(users: DataFrame) -> DataFrame:
    """Users with an unreadable code are counted under NULL."""
    return users.groupBy("CountryCod").agg(F.count("*").alias("n"))


def profiles_by_id(users: DataFrame, *columns: str) -> DataFrame:
    """``ID`` and ``columns`` of users with a readable id.

    Ids are unique by contract; ``contract_violations`` reports those that are
    not. A repeated id stays repeated: a join with it gives a row for each.
    """
    return users.where(F.col("ID").isNotNull()).select("ID", *columns)


def one_profile_per_id(users: DataFrame, *columns: str) -> DataFrame:
    """The same with one row per id, the greatest of its profiles; for few users, as it sorts."""
    return (
        profiles_by_id(users, *columns)
        .groupBy("ID")
        .agg(F.max(F.struct(*columns)).alias("profile"))
        .select("ID", "profile.*")
    )
