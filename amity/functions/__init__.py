from amity.functions.text import (
    access_summary,
    equals_ignore_case,
    field_count,
    parse_long,
    split_fields,
    starts_like_number,
    trim_controls,
)
from amity.functions.time import minutes_cutoff, moment

__all__ = [
    "access_summary",
    "equals_ignore_case",
    "field_count",
    "minutes_cutoff",
    "moment",
    "parse_long",
    "split_fields",
    "starts_like_number",
    "trim_controls",
]
