"""Comma-separated inputs.

Files are read as lines, and each line is split once, which gives its fields and
their number together. Fields are text until the record-shape test is done, so
that a bad value in a column nobody asked for cannot remove a row.

A quote opens a field only at the field's start. Lines with quotes are split by
one pattern, which takes a quote that is never closed, or stands inside a field, as text.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amity.functions import (
    parse_long,
    split_fields,
    starts_like_number,
    trim_controls,
)
from amity.schemas import ACCESS_LOGS, ASSOCIATES, USERS


class Fields(NamedTuple):
    """How many fields a record must have to count."""

    at_least: int
    at_most: int | None = None


AT_LEAST_3 = Fields(3)
AT_LEAST_5 = Fields(5)
EXACTLY_5 = Fields(5, 5)


# A field behind a comma: in quotes with what follows them, or plain.
_FIELD = r',(?:"((?:[^"]++|"")*+)"([^,]*+)|([^,]*+))'
# Marks that no line can hold, as each begins with a line feed: before a field, and around the content of quotes.
_MARKED = "\n,\n($1\n)$2$3"
# A doubled quote within the marks, and what stands before it since the mark or the one before.
_DOUBLED = r'(?:(\n\([^\n"]*+)|\G(?!\A)([^\n"]*+))""'


def raw_from_lines(lines: DataFrame, table: T.StructType, *keep: str) -> DataFrame:
    """Text columns of ``table`` and ``n_fields`` from a column ``value`` of lines, beside the
    columns ``keep``.

    Empty fields at the end of a line do not count. ``explode`` of one element
    keeps later filters on the fields from being pushed below the split, where
    each of them would split the line again.
    """
    names = table.fieldNames()
    fields = lines.select(*keep, F.explode(F.array(fields_of(F.col("value")))).alias("f"))
    return fields.select(
        *keep, *[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(names)], F.size("f").alias("n_fields")
    )


def fields_of(line: Column) -> Column:
    """The fields of a line. Most have no quote and are split at their commas."""
    return F.when(~F.contains(line, F.lit('"')), split_fields(line)).otherwise(_quoted_fields(line))


def _quoted_fields(line: Column) -> Column:
    """Any line, split by pattern. What follows a closing quote belongs to its field.

    All of it is text replacement, which Spark compiles with the rest of the stage; a
    function over the array of fields would keep the whole split, plain lines included, out of that.
    """
    marked = F.regexp_replace(F.concat(F.lit(","), line), _FIELD, _MARKED)
    single = F.when(F.contains(line, F.lit('""')), F.regexp_replace(marked, _DOUBLED, '$1$2"')).otherwise(marked)
    filled = F.regexp_replace(F.regexp_replace(single, r"\n[()]", ""), r"(?:\n,)++$", "")
    return F.split(F.substring(filled, 3, 2**31 - 1), r"\n,")


def read_raw(spark: SparkSession, path: str, table: T.StructType) -> DataFrame:
    """The same from files; header lines, known by the name of the first column, are left out."""
    name = table.fieldNames()[0]
    return raw_from_lines(spark.read.text(path), table).where(_is_data(F.col(name), name))


def typed(raw: DataFrame, table: T.StructType, fields: Fields) -> DataFrame:
    """Records of the right shape, trimmed and cast. Unreadable numbers become NULL."""
    kept = raw.where(F.col("n_fields") >= fields.at_least)
    if fields.at_most is not None:
        kept = kept.where(F.col("n_fields") <= fields.at_most)
    return kept.select(*typed_columns(table, [F.col(f"`{f.name}`") for f in table]))


def typed_columns(table: T.StructType, columns: list[Column]) -> list[Column]:
    return [
        (
            trim_controls(c) if isinstance(f.dataType, T.StringType) else parse_long(c, f.dataType.simpleString())
        ).alias(f.name)
        for f, c in zip(table, columns, strict=True)
    ]


def read_users(spark: SparkSession, path: str, fields: Fields = AT_LEAST_5) -> DataFrame:
    return typed(read_raw(spark, path, USERS), USERS, fields)


def read_associates(spark: SparkSession, path: str, fields: Fields = AT_LEAST_3) -> DataFrame:
    return typed(read_raw(spark, path, ASSOCIATES), ASSOCIATES, fields)


def read_access_logs(spark: SparkSession, path: str, fields: Fields = AT_LEAST_3) -> DataFrame:
    return typed(read_raw(spark, path, ACCESS_LOGS), ACCESS_LOGS, fields)


def _is_data(first: Column, name: str) -> Column:
    """Whether a record is none of the header lines, known by the name of their first column."""
    return starts_like_number(first) | (F.lower(trim_controls(first)) != name.lower())


FRIENDSHIP, ACCESS = "friendship", "access"


def tagged_merged(lines: DataFrame, is_friendship: Column | None = None) -> DataFrame:
    """The records of mixed lines of friendships and accesses, as text, with ``kind``.

    ``lines`` has the lines in its column ``value``, as ``spark.read.text`` gives them. Every line
    is split once. A friendship has its ends in the second and third column, named
    as those of an access. Header lines of either table are left out.

    Without more, a friendship has 3 fields and an access 5, and a friendship with all its five
    columns cannot be told from an access. ``is_friendship``, a condition on the other columns of
    ``lines`` such as the name of the file a line came from, tells them apart by provenance; then
    a friendship has 3 fields or more, and an access 5.
    """
    names = [*ACCESS_LOGS.fieldNames(), "n_fields"]
    if is_friendship is None:
        raw = raw_from_lines(lines, ACCESS_LOGS)
        kind = F.when(F.col("n_fields") == 3, FRIENDSHIP).when(F.col("n_fields") == 5, ACCESS)
    else:
        told = lines.select("value", F.coalesce(is_friendship, F.lit(False)).alias("_friend"))
        raw = raw_from_lines(told, ACCESS_LOGS, "_friend")
        enough = F.when(F.col("_friend"), F.col("n_fields") >= 3).otherwise(F.col("n_fields") == 5)
        kind = F.when(enough, F.when(F.col("_friend"), FRIENDSHIP).otherwise(ACCESS))
    first = F.col(ACCESS_LOGS.fieldNames()[0])
    data = _is_data(first, ACCESS_LOGS.fieldNames()[0]) & _is_data(first, ASSOCIATES.fieldNames()[0])
    return raw.select(*names, kind.alias("kind")).where(F.col("kind").isNotNull() & data)


def read_merged_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of mixed files, each with the name of its ``file``."""
    return spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"))


def split_merged(lines: DataFrame, is_friendship: Column | None = None) -> DataFrame:
    """Friendships and accesses out of mixed lines, read once: ``kind``, and a typed record in
    ``friendship`` or ``access``. ``is_friendship`` as in ``tagged_merged``; with it a friendship
    has its date and description too, where its line has them."""
    friends = ASSOCIATES if is_friendship is not None else T.StructType(ASSOCIATES.fields[:3])
    raw = tagged_merged(lines, is_friendship)
    names = raw.columns
    friendship = F.struct(*typed_columns(friends, [F.col(c) for c in names[: len(friends)]]))
    access = F.struct(*typed_columns(ACCESS_LOGS, [F.col(c) for c in names[: len(ACCESS_LOGS)]]))
    return raw.select(
        "kind",
        F.when(F.col("kind") == FRIENDSHIP, friendship).alias(FRIENDSHIP),
        F.when(F.col("kind") == ACCESS, access).alias(ACCESS),
    )
