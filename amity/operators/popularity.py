"""Owners by their outgoing friendships."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amity.operators.users import profiles_by_id

# The two labels.
MORE_POPULAR = "More Popular"
NOT_MORE_POPULAR = "Not More Popular"


def owner_degrees(associates: DataFrame) -> DataFrame:
    return (
        associates.where(F.col("PersonA_ID").isNotNull())
        .groupBy("PersonA_ID")
        .agg(F.count("*").alias("n"))
    )


def popularity_labels(
    associates: DataFrame, threshold: int = 1, users: DataFrame | None = None
) -> DataFrame:
    """"More Popular" for owners with more than ``threshold`` outgoing friendships.

    Without ``users``, owners without an outgoing friendship do not appear. With
    ``users``, every user is labelled, and owners who are not users are left out.
    """
    degrees = owner_degrees(associates)
    if users is not None:
        ids = (
            users.where(F.col("ID").isNotNull()).select(F.col("ID").alias("PersonA_ID")).distinct()
        )
        degrees = ids.join(degrees, "PersonA_ID", "left").fillna(0, "n")
    return degrees.select(
        F.col("PersonA_ID").alias("owner"),
        F.when(F.col("n") > threshold, MORE_POPULAR).otherwise(NOT_MORE_POPULAR).alias("label"),
    )


def owner_degree_profiles(associates: DataFrame, users: DataFrame) -> DataFrame:
    """Outgoing friendships of each owner beside the owner's whole profile."""
    profiles = profiles_by_id(users, "Name", "Nationality", "CountryCod", "Hobby")
    return (
        owner_degrees(associates)
        .join(profiles, F.col("PersonA_ID") == F.col("ID"))
        .select("PersonA_ID", "n", "ID", "Name", "Nationality", "CountryCod", "Hobby")
    )
