"""Points in time are always given by the caller, so results can be repeated."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the inactivity window, in days.
INACTIVITY_DAYS = 90

INACTIVITY_MILLIS = INACTIVITY_DAYS * 24 * 60 * 60 * 1000


def moment(value: int | str | date | datetime, dtype: T.DataType) -> Column:
    """A literal of the time column's own type.

    Dates go in as text, so a naive datetime means the same wall-clock time
    whatever the zone of the driver machine. A column without zone can't be held
    against a datetime with one.
    """
    if isinstance(value, datetime) and value.tzinfo and isinstance(dtype, T.TimestampNTZType):
        raise ValueError(f"the accesses have no time zone, but {value} has one")
    if isinstance(value, date):
        value = value.isoformat()
    return F.lit(value).cast(dtype)


def minutes_cutoff(now_seconds: float, days: float = INACTIVITY_DAYS) -> float:
    """Epoch minutes of the moment ``days`` before ``now_seconds``."""
    return now_seconds / 60 - days * 24 * 60
