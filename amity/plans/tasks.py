"""The eight tasks, each from files to files, in a standard and an alternative form.

The two forms of a task differ in what they accept, compute or write; the
parameter ``alternative`` picks the second. ``order`` sorts the result by its first
column, ``"numeric"`` or ``"text"``, at the cost of a range shuffle.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amity import operators as ops
from amity.functions.time import INACTIVITY_DAYS, INACTIVITY_MILLIS, minutes_cutoff
from amity.operators.friends import NEVER_ACCESSED, NEVER_ACCESSED_PAGE
from amity.operators.ordering import ordered
from amity.schemas import ACCESS_LOGS
from amity.sinks import write_outputs, write_text
from amity.sources import (
    AT_LEAST_3,
    AT_LEAST_5,
    EXACTLY_5,
    Fields,
    read_access_logs,
    read_associates,
    read_merged_lines,
    read_raw,
    read_users,
    typed,
)


def _write(df: DataFrame, out: str, order: str | None, **how: str | None) -> None:
    write_text(ordered(df, df.columns[0], order), out, **how)


def _mode(overwrite: bool) -> str:
    return "overwrite" if overwrite else "errorifexists"


def task_a(
    spark: SparkSession, users: str, out: str, nationality: str = "India", alternative: bool = False,
    order: str | None = None,
) -> None:
    """Name and hobby of users of one nationality; the alternative ignores case."""
    found = ops.users_by_nationality(
        read_users(spark, users, AT_LEAST_5), nationality, ignore_case=alternative
    )
    _write(found, out, order, mode="overwrite")


def task_b(
    spark: SparkSession, users: str, logs: str, out: str, k: int = 10, alternative: bool = False,
    order: str | None = None,
) -> None:
    """The most visited pages; the alternative takes shorter profiles and keeps old results."""
    profiles = read_users(spark, users, AT_LEAST_3 if alternative else EXACTLY_5)
    report = ops.top_pages(read_access_logs(spark, logs, AT_LEAST_3), profiles, k)
    _write(report, out, order, value_sep=",", mode=_mode(not alternative))


def task_c(
    spark: SparkSession, users: str, out: str, alternative: bool = False, order: str | None = None
) -> None:
    """Users per nationality, gzipped; the alternative writes plain text and keeps old results."""
    counts = ops.users_per_nationality(read_users(spark, users, EXACTLY_5))
    _write(
        counts, out, order, mode=_mode(not alternative), compression=None if alternative else "gzip"
    )


def task_d(
    spark: SparkSession, users: str, associates: str, out: str, alternative: bool = False,
    order: str | None = None,
) -> None:
    """Name and relationship count of each owner; the alternative takes shorter profiles."""
    owners = read_users(spark, users, Fields(2) if alternative else AT_LEAST_5)
    counts = ops.relationship_counts(owners, read_associates(spark, associates, AT_LEAST_3))
    _write(counts.select("Name", "n"), out, order, sep=",", mode="overwrite")


def task_e(
    spark: SparkSession, logs: str, out: str, alternative: bool = False, order: str | None = None
) -> None:
    """Access statistics per visitor; the alternative sorts by id and keeps old results."""
    stats = ops.access_stats(
        read_access_logs(spark, logs, AT_LEAST_5),
        formatted=True,
        order_key=order or ("numeric" if alternative else None),
    )
    write_text(stats, out, mode=_mode(not alternative))


def task_f(
    spark: SparkSession, associates: str, logs: str, out: str, order: str | None = None
) -> None:
    """The owner of every friendship whose page was never visited, once per friendship."""
    pairs = ops.unvisited_friend_pairs(
        read_associates(spark, associates, AT_LEAST_3), read_access_logs(spark, logs, AT_LEAST_3)
    )
    _write(pairs.select("PersonA_ID", F.lit(NEVER_ACCESSED_PAGE)), out, order, mode="overwrite")


def task_f_alternative(
    spark: SparkSession, merged: str, out: str, friend_files: str | None = None, order: str | None = None
) -> None:
    """Owners who visited no friend at all, from files of friendships and accesses.

    ``friend_files`` is a pattern of the names of the files that hold friendships, which may have all
    their columns then; the other files hold accesses.
    """
    of_friends = None if friend_files is None else F.col("file").rlike(friend_files)
    owners = ops.owners_visiting_no_friend_merged(read_merged_lines(spark, merged), of_friends)
    _write(owners.select("PersonA_ID", F.lit(NEVER_ACCESSED)), out, order)


def task_g(
    spark: SparkSession,
    logs: str,
    out: str,
    as_of: int | str | date | datetime,
    window: int = INACTIVITY_MILLIS,
    order: str | None = None,
) -> None:
    """Visitors not seen for longer than the window, as the output ``inactivePersons``."""
    accesses = read_access_logs(spark, logs, EXACTLY_5)
    _write(ops.inactive_users(accesses, as_of, window), out, order, name="inactivePersons")


def task_g_outputs(
    spark: SparkSession, logs: str, out: str, as_of: int, window: int = INACTIVITY_MILLIS
) -> dict[str, int]:
    """Main and named output of one job, and what it met on the way, from one read of the accesses.

    ``out/run=<as_of>/output=main`` has every visitor's last access, ``output=inactivePersons`` those
    not seen for longer than the window. Returned are the counts of ``record_quality``.
    """
    raw, counts = ops.observed_quality(read_raw(spark, logs, ACCESS_LOGS))
    last = ops.latest_access(typed(raw, ACCESS_LOGS, EXACTLY_5))
    gone = F.lit(as_of) - F.col("last") > F.lit(window)
    outputs = F.when(gone, F.array(F.lit("main"), F.lit("inactivePersons"))).otherwise(F.array(F.lit("main")))
    rows = last.select("ByWho", "last", F.explode(outputs).alias("output"))
    write_outputs(rows.withColumn("last", F.when(F.col("output") == "main", F.col("last"))), out, str(as_of))
    return counts.get


def task_g_minutes(
    spark: SparkSession,
    logs: str,
    out: str,
    now: float,
    days: float = INACTIVITY_DAYS,
    order: str | None = None,
) -> None:
    """The same for access times in epoch minutes; ``now`` is in epoch seconds."""
    accesses = read_access_logs(spark, logs, EXACTLY_5)
    inactive = ops.inactive_users_minutes(accesses, minutes_cutoff(now, days))
    _write(inactive, out, order, name="inactivePersons")


def task_h(
    spark: SparkSession, associates: str, out: str, threshold: int = 1, users: str | None = None,
    order: str | None = None,
) -> None:
    """Popularity label per owner; with ``users``, also of owners without friendships."""
    everyone: DataFrame | None = None if users is None else read_users(spark, users, Fields(1))
    labels = ops.popularity_labels(
        read_associates(spark, associates, AT_LEAST_3), threshold, everyone
    )
    _write(labels, out, order)
