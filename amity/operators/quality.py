"""Reports on what the tables hold and where they break their contract."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amity.functions import parse_long
from amity.sources.delimited import Fields, raw_from_lines, typed_columns


def _quality(n_fields: int, time_column: str) -> list[Column]:
    well_shaped = F.col("n_fields") == n_fields
    return [
        F.count("*").alias("rows"),
        F.count_if(~well_shaped).alias("wrong_arity"),
        F.count_if(well_shaped & parse_long(F.col(time_column)).isNull()).alias("invalid_time"),
    ]


def record_quality(raw: DataFrame, n_fields: int = 5, time_column: str = "AccessTime") -> DataFrame:
    """Records read, records of the wrong shape, and well-shaped ones with an unreadable time."""
    return raw.agg(*_quality(n_fields, time_column))


def observed_quality(
    raw: DataFrame, n_fields: int = 5, time_column: str = "AccessTime"
) -> tuple[DataFrame, Observation]:
    """``raw`` as it is, and the counts of ``record_quality``, which come with the first job that
    reads it to its end; ``Observation.get`` waits for that. Counting takes no pass of its own."""
    counts = Observation("record quality")
    return raw.observe(counts, *_quality(n_fields, time_column)), counts


#: Reason of a record with the wrong number of fields; other reasons name the unreadable column.
WRONG_ARITY = "wrong number of fields"


def routed_records(lines: DataFrame, table: T.StructType, fields: Fields) -> DataFrame:
    """Each line with its record and what becomes of it, from one split: ``line, n_fields, reason``
    and a struct ``record`` of the columns of ``table``.

    ``reason`` is NULL for records that are accepted. Others have the wrong number of fields, or
    hold no readable number in a number column, of which the first is named. An empty field is no
    number. ``record`` is what ``typed`` gives, whatever the reason.
    """
    raw = raw_from_lines(lines.select("value", F.col("value").alias("line")), table, "line")
    shaped = F.col("n_fields") >= fields.at_least
    if fields.at_most is not None:
        shaped &= F.col("n_fields") <= fields.at_most
    record = F.struct(*typed_columns(table, [F.col(f"`{c}`") for c in table.fieldNames()]))
    reason = F.when(shaped, None).otherwise(WRONG_ARITY)  # a NULL line has no fields
    # ``explode`` keeps the numbers from being read again for their test.
    routed = raw.select("line", "n_fields", reason.alias("shape"), F.explode(F.array(record)).alias("record"))
    unreadable = [
        F.when(F.col("record").getField(f.name).isNull(), f.name)
        for f in table.fields
        if isinstance(f.dataType, T.NumericType)
    ]
    return routed.select("line", "n_fields", F.coalesce("shape", *unreadable).alias("reason"), "record")


def rejected_records(lines: DataFrame, table: T.StructType, fields: Fields) -> DataFrame:
    """``line, n_fields, reason`` of the lines that are no whole record of ``table``."""
    return routed_records(lines, table, fields).where(F.col("reason").isNotNull()).drop("record")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Data rows per table."""
    counts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _outside(col: str, low: int, high: int) -> Column:
    """Unreadable values are outside too."""
    return ~F.coalesce(F.col(col).between(low, high), F.lit(False))


def _repeated(key: str) -> Column:
    return F.count_if(F.col(key).isNotNull() & (F.col("copies") > 1))


def _report(totals: DataFrame, table: str) -> DataFrame:
    return totals.unpivot([], totals.columns, "rule", "n").select(F.concat(F.lit(f"{table}."), "rule").alias("rule"), "n")


def _violations(df: DataFrame, key: str, table: str, rules: dict[str, Column]) -> DataFrame:
    """Ids that repeat, and rows that break a rule, from one shuffle on the id.

    Rule breaks are summed per id map-side, so one id on very many rows is no burden.
    """
    per_id = df.groupBy(key).agg(
        F.count("*").alias("copies"), *[F.count_if(r).alias(n) for n, r in rules.items()]
    )
    totals = per_id.agg(
        _repeated(key).alias("repeated_id"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in rules]
    )
    return _report(totals, table)


def _friendship_violations(associates: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rules on the id and on the unordered pair, which are two groupings, from one read.

    Each friendship goes once by its id and once by its pair, as grouping sets: one shuffle of both,
    merged map-side. A pair stored in both directions is one whose lower end stands first
    in some row and second in another.
    """
    a, b = F.col("PersonA_ID"), F.col("PersonB_ID")
    ends = associates.select(
        "FriendRel",
        F.least(a, b).alias("low"),
        F.greatest(a, b).alias("high"),
        F.when(a < b, 1).when(a > b, 2).otherwise(0).alias("way"),
        *[r.cast("int").alias(n) for n, r in rules.items()],
    )
    by_id, pair = F.col("FriendRel"), [F.col("low"), F.col("high")]
    grouped = ends.groupingSets([[by_id], pair], by_id, *pair).agg(
        F.grouping("FriendRel").alias("is_pair"),
        F.count("*").alias("copies"),
        F.bit_or("way").alias("ways"),
        *[F.sum(n).alias(n) for n in rules],
    )
    of_id = F.col("is_pair") == 0
    totals = grouped.agg(
        F.count_if(of_id & F.col("FriendRel").isNotNull() & (F.col("copies") > 1)).alias("repeated_id"),
        *[F.coalesce(F.sum(F.when(of_id, F.col(n))), F.lit(0)).alias(n) for n in rules],
        F.count_if(~of_id & (F.col("ways") == 3)).alias("reciprocal"),
    )
    return _report(totals, "associates")


def contract_violations(
    users: DataFrame,
    associates: DataFrame,
    logs: DataFrame,
    max_id: int = 200_000,
    max_country_code: int = 50,
) -> DataFrame:
    """How often each documented rule of the three tables is broken."""
    reports = [
        _violations(users, "ID", "users", {
            "id_range": _outside("ID", 1, max_id),
            "country_code_range": _outside("CountryCod", 1, max_country_code),
        }),
        _friendship_violations(associates, {
            "person_range": _outside("PersonA_ID", 1, max_id) | _outside("PersonB_ID", 1, max_id),
            "self_friend": F.col("PersonA_ID") == F.col("PersonB_ID"),
        }),
        _violations(logs, "AccessId", "access_logs", {
            "person_range": _outside("ByWho", 1, max_id) | _outside("WhatPage", 1, max_id),
        }),
    ]
    return reduce(DataFrame.unionByName, reports)
