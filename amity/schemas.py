"""The three tables: user profiles, one-directional friendships, page accesses.

Ids are bigint: the tables outgrow 32 bits at cluster scale, and one id type on
both sides of every join lets a shuffle made for an aggregation serve the join.
"""

from __future__ import annotations

from pyspark.sql import types as T

USERS = T.StructType([
    T.StructField("ID", T.LongType()),
    T.StructField("Name", T.StringType()),
    T.StructField("Nationality", T.StringType()),
    T.StructField("CountryCod", T.IntegerType()),
    T.StructField("Hobby", T.StringType()),
])

ASSOCIATES = T.StructType([
    T.StructField("FriendRel", T.LongType()),
    T.StructField("PersonA_ID", T.LongType()),
    T.StructField("PersonB_ID", T.LongType()),
    T.StructField("DateofFriendship", T.IntegerType()),
    T.StructField("Desc", T.StringType()),
])

ACCESS_LOGS = T.StructType([
    T.StructField("AccessId", T.LongType()),
    T.StructField("ByWho", T.LongType()),
    T.StructField("WhatPage", T.LongType()),
    T.StructField("TypeOfAccess", T.StringType()),
    T.StructField("AccessTime", T.LongType()),
])
