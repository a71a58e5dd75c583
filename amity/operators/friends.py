"""Questions on friendships, alone and against page visits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amity.functions import parse_long
from amity.operators.users import profiles_by_id
from amity.sources import FRIENDSHIP, tagged_merged

# What is known of a pair (A, B); a pair that is both carries both bits.
FRIEND, VISITED = 1, 2

# The two messages.
NEVER_ACCESSED_PAGE = "Never Accessed Friend’s Page"
NEVER_ACCESSED = "Never Accessed"


def relationship_counts(users: DataFrame, associates: DataFrame) -> DataFrame:
    """How often each owner appears on either side of a friendship; 0 is reported.

    Ends are counted map-side before the shuffle on the id, which the join then
    reuses: the users are the only other thing shuffled.
    """
    ends = (
        associates.select(F.explode(F.array("PersonA_ID", "PersonB_ID")).alias("ID"))
        .where(F.col("ID").isNotNull())
        .groupBy("ID")
        .agg(F.count("*").alias("n"))
    )
    return (
        profiles_by_id(users, "Name")
        .join(ends, "ID", "left")
        .select("ID", "Name", F.coalesce("n", F.lit(0)).alias("n"))
    )


def _once(marked: DataFrame) -> DataFrame:
    return marked.groupBy("PersonA_ID", "PersonB_ID").agg(F.bit_or("mark").alias("mark"))


#: Bits of a sieve, whatever the number of friendships: 1 MiB, 131,072 rows.
SIEVE_BITS = 1 << 23


def _with_place(pairs: DataFrame, bits: int) -> DataFrame:
    """Numbers of any width hash as ``bigint``, as the same number of another width hashes otherwise."""
    whole = isinstance(pairs.schema["PersonA_ID"].dataType, T.IntegralType)
    ends = [F.col(c).cast("bigint") if whole else F.col(c) for c in ("PersonA_ID", "PersonB_ID")]
    place = F.pmod(F.xxhash64(*ends), F.lit(bits))
    return pairs.withColumns({"word": F.shiftright(place, 6), "bit": (place % 64).cast("int")})


def pair_sieve(pairs: DataFrame, bits: int = SIEVE_BITS) -> DataFrame:
    """``word, set``: of ``bits`` bits, 64 a row, those that the pairs (PersonA_ID, PersonB_ID) hash to.

    Pairs are merged map-side, so a task sends at most ``bits / 64`` rows, and no more are the result,
    however many pairs there are. With more pairs than bits the sieve lets nearly
    everything through, which costs its test and changes no result.
    """
    set_bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))
    return _with_place(pairs, bits).groupBy("word").agg(F.bit_or(set_bit).alias("set"))


def _sieved(visits: DataFrame, friends: DataFrame, bits: int) -> DataFrame:
    """The visits that may match a friendship. Equal pairs hash alike, so no match is lost."""
    kinds = {isinstance(f.dataType, T.IntegralType) or f.dataType for df in (visits, friends) for f in df.schema}
    if len(kinds) > 1:
        raise ValueError("a sieve needs ids of one type on both sides, or whole numbers")
    # At most bits / 64 rows of two numbers.
    sieve = F.broadcast(pair_sieve(friends, bits))
    is_set = F.call_function("shiftright", F.col("set"), F.col("bit")).bitwiseAND(F.lit(1)) == 1
    return _with_place(visits, bits).join(sieve, "word").where(is_set).select(*visits.columns)


def marked_pairs(associates: DataFrame, logs: DataFrame, sieve_bits: int | None = None) -> DataFrame:
    """Every friendship once, with its bits; also visits that are no friendship, with their own.

    One grouping stands in for "distinct friendships" joined to "distinct
    visits": a single shuffle on both columns, no sort, and equal pairs are
    merged map-side, so neither an owner with very many friends nor a visit
    repeated very often ends up in one task. Friendships with an unreadable end
    are left out; such visits match none.

    With ``sieve_bits`` the friendships are read once more before, into a set of so many bits, and
    visits whose pair is not in it are not shuffled. That is for visits that
    outnumber the friendships by far; it changes no friendship's bits.
    """
    known = F.col("PersonA_ID").isNotNull() & F.col("PersonB_ID").isNotNull()
    friends = associates.where(known).select("PersonA_ID", "PersonB_ID")
    visits = logs.select(F.col("ByWho").alias("PersonA_ID"), F.col("WhatPage").alias("PersonB_ID"))
    if sieve_bits is not None:
        visits = _sieved(visits, friends, sieve_bits)
    marked = friends.withColumn("mark", F.lit(FRIEND)).unionByName(visits.withColumn("mark", F.lit(VISITED)))
    return _once(marked)


def marked_pairs_merged(lines: DataFrame, is_friendship: Column | None = None) -> DataFrame:
    """The same from mixed lines, read once; both kinds hold the pair in their second and third field.

    ``is_friendship`` as in ``tagged_merged``.
    """
    records = tagged_merged(lines, is_friendship)
    mark = F.when(F.col("kind") == FRIENDSHIP, FRIEND).otherwise(VISITED)
    ends = records.select(
        parse_long(F.col("ByWho")).alias("PersonA_ID"), parse_long(F.col("WhatPage")).alias("PersonB_ID"), mark.alias("mark")
    )
    # Unreadable ends are left out after the grouping, where they are few: a test before would parse again.
    known = F.count_if(F.col("PersonA_ID").isNotNull() & F.col("PersonB_ID").isNotNull())
    grouped = ends.groupBy("PersonA_ID", "PersonB_ID").agg(F.bit_or("mark").alias("mark"), known.alias("known"))
    return grouped.where(F.col("known") > 0).drop("known")


def unvisited_friend_pairs(associates: DataFrame, logs: DataFrame, sieve_bits: int | None = None) -> DataFrame:
    """Friendships (A, B) where A never visited B's page."""
    return (
        marked_pairs(associates, logs, sieve_bits)
        .where(F.col("mark") == FRIEND)
        .select("PersonA_ID", "PersonB_ID")
    )


def owners_with_unvisited_friend(
    associates: DataFrame, logs: DataFrame, sieve_bits: int | None = None
) -> DataFrame:
    """Owners with at least one friend whose page they never visited."""
    return unvisited_friend_pairs(associates, logs, sieve_bits).select("PersonA_ID").distinct()


def _without_visited_friend(pairs: DataFrame) -> DataFrame:
    """The greatest mark among an owner's friendships tells whether any was visited."""
    return (
        pairs.where(F.col("mark") != VISITED)
        .groupBy("PersonA_ID")
        .agg(F.max("mark").alias("mark"))
        .where(F.col("mark") == FRIEND)
        .select("PersonA_ID")
    )


def owners_visiting_no_friend(
    associates: DataFrame, logs: DataFrame, sieve_bits: int | None = None
) -> DataFrame:
    """Owners who have friends and visited the page of none of them."""
    return _without_visited_friend(marked_pairs(associates, logs, sieve_bits))


def owners_visiting_no_friend_merged(lines: DataFrame, is_friendship: Column | None = None) -> DataFrame:
    return _without_visited_friend(marked_pairs_merged(lines, is_friendship))
