"""Order of result rows, on request only: it costs a range shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered(df: DataFrame, key: str, order_key: str | None) -> DataFrame:
    """``"numeric"`` sorts by value, shorter text before longer; ``"text"`` by the bytes of the text."""
    if order_key is None:
        return df
    if order_key == "text":
        return df.orderBy(F.col(key).cast("string"))
    if order_key != "numeric":
        raise ValueError(f"order_key must be 'numeric', 'text' or None, not {order_key!r}")
    if df.schema[key].dataType.typeName() == "string":
        return df.orderBy(F.octet_length(key), key)
    return df.orderBy(key)
