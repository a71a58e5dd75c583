from amity.sources.delimited import (
    ACCESS,
    AT_LEAST_3,
    AT_LEAST_5,
    EXACTLY_5,
    FRIENDSHIP,
    Fields,
    raw_from_lines,
    read_access_logs,
    read_associates,
    read_merged_lines,
    read_raw,
    read_users,
    split_merged,
    tagged_merged,
    typed,
)

__all__ = [
    "ACCESS",
    "AT_LEAST_3",
    "AT_LEAST_5",
    "EXACTLY_5",
    "FRIENDSHIP",
    "Fields",
    "raw_from_lines",
    "read_access_logs",
    "read_associates",
    "read_merged_lines",
    "read_raw",
    "read_users",
    "split_merged",
    "tagged_merged",
    "typed",
]
