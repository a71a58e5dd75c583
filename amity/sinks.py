"""Results as lines of text, tables as comma-separated files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lines(df: DataFrame, sep: str = "\t", value_sep: str | None = None) -> DataFrame:
    """One column ``value``: the key, ``sep``, then the other columns.

    ``value_sep`` stands between the columns after the key (default: ``sep``).
    Text is written as it is, without quotes. One column gives key-only lines.
    """
    return df.select(_line(df.columns, sep, value_sep).alias("value"))


def _line(columns: list[str], sep: str, value_sep: str | None) -> Column:
    key, *rest = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns]
    if not rest:
        return key
    values = rest if value_sep is None else [F.concat_ws(value_sep, *rest)]
    return F.concat_ws(sep, key, *values)


def write_text(
    df: DataFrame,
    path: str,
    sep: str = "\t",
    value_sep: str | None = None,
    mode: str = "errorifexists",
    compression: str | None = None,
    name: str | None = None,
) -> None:
    """Write result lines.

    ``mode="overwrite"`` replaces an older result, ``"errorifexists"`` refuses
    to. ``name`` writes a named output below ``path``.
    """
    target = f"{path.rstrip('/')}/{name}" if name else path
    lines(df, sep, value_sep).write.mode(mode).text(target, compression=compression)


def write_outputs(
    outputs: DataFrame, path: str, run: str, sep: str = "\t", value_sep: str | None = None
) -> None:
    """Several outputs of one job, by one write, hence from one computation of their rows.

    Column ``output`` names the output that a row is for; an array in it stands for several, and
    none for no output. Lines of the other columns go to ``path/run=…/output=…``.

    A rerun replaces all outputs of its own ``run`` and leaves other runs as they are. An output
    that gets no rows this time is gone then; had only the folders with
    new rows been replaced, its old lines would have stayed. NULL columns at the end of a
    line are left out, so that outputs may have fewer columns.
    """
    columns = [c for c in outputs.columns if c != "output"]
    if outputs.schema["output"].dataType.typeName() == "array":
        outputs = outputs.withColumn("output", F.explode("output"))
    line = F.lit(None).cast("string")
    for n in range(1, len(columns) + 1):
        # The last column that is not NULL decides.
        line = F.when(F.col(f"`{columns[n - 1]}`").isNotNull(), _line(columns[:n], sep, value_sep)).otherwise(line)
    written = outputs.where(F.col("output").isNotNull()).select("output", F.coalesce(line, F.lit("")).alias("value"))
    written.write.mode("overwrite").partitionBy("output").text(f"{path.rstrip('/')}/run={run}")


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a table in the format the readers expect: a header in every file."""
    df.write.mode(mode).csv(path, header=True, emptyValue="", escape='"')
