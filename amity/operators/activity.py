"""Who has not been seen for a while."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amity.functions.time import INACTIVITY_MILLIS, moment


def latest_access(logs: DataFrame) -> DataFrame:
    """Last access per visitor; a number before time 0 counts as 0."""
    last = F.max("AccessTime")
    if isinstance(logs.schema["AccessTime"].dataType, T.NumericType):
        last = F.greatest(last, F.lit(0))
    return (
        logs.where(F.col("ByWho").isNotNull() & F.col("AccessTime").isNotNull())
        .groupBy("ByWho")
        .agg(last.alias("last"))
    )


def inactive_users(
    logs: DataFrame,
    as_of: int | str | date | datetime,
    window: int | timedelta = INACTIVITY_MILLIS,
) -> DataFrame:
    """Visitors whose last access is more than ``window`` before ``as_of``.

    Number columns take numbers in their own unit (milliseconds by default),
    timestamp columns a date or datetime and a ``timedelta``. Users who never
    visited a page are not reported: they have no last access.
    """
    now = moment(as_of, logs.schema["AccessTime"].dataType)
    return latest_access(logs).where(now - F.col("last") > F.lit(window)).select("ByWho")


def inactive_users_minutes(logs: DataFrame, cutoff_minutes: float) -> DataFrame:
    """Visitors whose last access, in epoch minutes, is before the cutoff."""
    return latest_access(logs).where(F.col("last") < cutoff_minutes).select("ByWho")
