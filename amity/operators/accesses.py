"""Page visits: per page, and per visitor."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amity.functions import access_summary
from amity.operators.ordering import ordered
from amity.operators.users import one_profile_per_id

UNKNOWN = "Unknown"


def visits_per_page(logs: DataFrame) -> DataFrame:
    """Rows without readable page are left out after the grouping, where they are one row a
    task: a test before it would read the page's text a second time."""
    return logs.groupBy("WhatPage").agg(F.count("WhatPage").alias("n")).where(F.col("n") > 0)


def top_pages(
    logs: DataFrame, users: DataFrame, k: int = 10, with_count: bool = True
) -> DataFrame:
    """The ``k`` most visited pages with their owners' profiles, lower page id first on ties.

    The limit comes before the lookup, so both joins are with at most ``k``
    rows: first the user table is cut to the report's owners, then their profiles
    go back to the report. Spark knows the size of a limit and chooses the joins
    by it; both uses of the report share one shuffle of the counts. The ``k`` rows
    have to fit one task.
    """
    top = visits_per_page(logs).orderBy(F.desc("n"), "WhatPage").limit(k)
    wanted = users.join(top.select(F.col("WhatPage").alias("ID")), "ID", "left_semi")
    profiles = one_profile_per_id(wanted, "Name", "Nationality")
    report = top.join(profiles, top.WhatPage == profiles.ID, "left").select(
        "WhatPage",
        F.coalesce("Name", F.lit(UNKNOWN)).alias("Name"),
        F.coalesce("Nationality", F.lit(UNKNOWN)).alias("Nationality"),
        "n",
    ).orderBy(F.desc("n"), "WhatPage")
    return report if with_count else report.drop("n")


def page_bitmaps(logs: DataFrame) -> DataFrame:
    """``ByWho, word, visits, pages``: for each visitor and run of 64 pages the number of visits, and
    which of the pages they were to, as a bitmap.

    A word holds as many pages as fit a number, so the rows are never more than those by
    (visitor, page), one number wider, and up to 64 times fewer; both aggregates merge map-side.
    Unreadable pages are in the word NULL, with visits and no bitmap. Pages of another type than
    whole numbers, such as text, are a word each. Tables of this form add up: see
    ``merged_access_stats``.
    """
    if isinstance(logs.schema["WhatPage"].dataType, T.IntegralType):
        word, page = F.shiftright("WhatPage", 6), F.expr("shiftleft(1L, cast(WhatPage & 63 as int))")
    else:
        word, page = F.col("WhatPage"), F.expr("if(WhatPage IS NULL, NULL, 1L)")
    return (
        logs.where(F.col("ByWho").isNotNull())
        .groupBy("ByWho", word.alias("word"))
        .agg(F.count("*").alias("visits"), F.bit_or(page).alias("pages"))
    )


def _stats(bitmaps: DataFrame) -> DataFrame:
    """From one row for each visitor and word."""
    return bitmaps.groupBy("ByWho").agg(
        F.sum("visits").alias("total"),
        F.coalesce(F.sum(F.bit_count("pages").cast("bigint")), F.lit(0)).alias("distinct_pages"),
    )


def merged_access_stats(*bitmaps: DataFrame) -> DataFrame:
    """The same as ``access_stats`` of all the accesses that the tables of ``page_bitmaps`` are from.

    A distinct count cannot be added up, its bitmaps can: a day's accesses become
    one table, and any days together are counted exactly without reading an access again.
    """
    both = reduce(DataFrame.unionByName, bitmaps)
    merged = both.groupBy("ByWho", "word").agg(F.sum("visits").alias("visits"), F.bit_or("pages").alias("pages"))
    return _stats(merged)


def access_stats(
    logs: DataFrame, formatted: bool = False, order_key: str | None = None
) -> DataFrame:
    """Total accesses and distinct pages per visitor.

    An access of an unreadable page counts in the total, but is no distinct page.

    Accesses become bitmaps per (visitor, run of pages) first, so a visitor with a third of all
    accesses is spread over the tasks by page, and what reaches the second
    grouping is one row per visitor and task.
    """
    stats = _stats(page_bitmaps(logs))
    if formatted:
        stats = stats.select(
            "ByWho", access_summary(F.col("total"), F.col("distinct_pages")).alias("summary")
        )
    return ordered(stats, "ByWho", order_key)
