"""Column expressions for delimited text. All of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything up to and including the space character counts as blank.
BLANKS = "".join(map(chr, range(0x21)))
PADDED_NUMBER = r"^[\x00-\x20]++[+-]?[0-9]++[\x00-\x20]*+$"


def trim_controls(col: Column) -> Column:
    """Strip spaces and control characters; ``F.trim`` alone strips only spaces."""
    return F.btrim(col, F.lit(BLANKS))


def split_fields(line: Column, limit: int = -1) -> Column:
    """Fields of a comma-separated line.

    Without a limit, empty fields at the end of the line do not count; with a
    limit, the last field holds the rest of the line as it is.
    """
    if limit > 0:
        return F.split(line, ",", limit)
    # Few lines end with a comma, and trimming costs more than looking.
    trimmed = F.when(F.endswith(line, F.lit(",")), F.rtrim(line, F.lit(","))).otherwise(line)
    return F.split(trimmed, ",")


def field_count(line: Column) -> Column:
    return F.size(split_fields(line))


def starts_like_number(col: Column) -> Column:
    """Whether text starts with a sign or digit; "+" to ":" is their range. Costs next to nothing."""
    return (col >= "+") & (col < ":")


def parse_long(col: Column, dtype: str = "bigint") -> Column:
    """Whole number or NULL, never an error; the cast itself trims blanks.

    ``try_cast`` alone would do, but inside it every bad value costs a Java
    exception. So text that starts with a letter, or with a blank and is no
    number, does not get there.
    """
    number = col.try_cast(dtype)
    padded = (col != "") & (col < "!") & col.rlike(PADDED_NUMBER)
    return F.when(starts_like_number(col), number).when(padded, number)


def equals_ignore_case(col: Column, value: str) -> Column:
    """Character-by-character equality ignoring case.

    ``lower(a) = lower(b)`` differs on letters whose case mapping is not one to
    one (dotless i, final sigma, the Kelvin sign). The length test is cheap and
    keeps the pattern away from nearly all rows.
    """
    quoted = "".join(c if c.isalnum() else f"\\x{{{ord(c):x}}}" for c in value)
    return (F.char_length(col) == len(value)) & col.rlike(rf"(?iu)\A{quoted}\z")


def access_summary(total: Column, distinct_pages: Column) -> Column:
    return F.format_string("TotalAccesses: %d, DistinctPages: %d", total, distinct_pages)
