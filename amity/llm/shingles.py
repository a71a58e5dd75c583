"""Near copies by the Jaccard similarity of their word shingles, exactly.

The shingles of a text are in the order of their hashes. Two sets of which at least
``similarity`` is common share one of the first ``n - ceil(similarity * n) + 1``
shingles of either (``n``: its own size), so texts meet by these and no pair is missed.
Texts of one shingle are held against the first of them; what that leaves in different
classes meets once more, where sizes and places in the order leave room for the
similarity. Each such pair is verified on its whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amity.llm.components import components
from amity.llm.simhash import shingle_hashes
from amity.llm.tables import shared_table

SHINGLE = 5
SIMILARITY = 0.8


def shingle_set(text: str, size: int = SHINGLE) -> np.ndarray:
    return np.unique(shingle_hashes(text, size))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / max(1, len(a) + len(b) - common)


def _prefixes(texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """``key, n, place, shingle`` of the shingles by which texts (``key, text``) meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, places, shingles = ([np.zeros(0, np.int64)] for _ in range(4))
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = shingle_set(value.as_py(), size)
                n = len(found)
                first = found[: n - ceil(similarity * n - 1e-9) + 1]
                keys.append(np.full(len(first), key, np.int64))
                sizes.append(np.full(len(first), n, np.int64))
                places.append(np.arange(len(first)))
                shingles.append(first.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in (keys, sizes, places, shingles)], ["key", "n", "place", "shingle"]
            )

    return texts.select("key", "text").mapInArrow(run, "key long, n long, place long, shingle long")


def _similar(pairs: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """Those of ``pairs`` (``a, b``) that are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [
                jaccard(shingle_set(x.as_py(), size), shingle_set(y.as_py(), size)) >= similarity - 1e-9
                for x, y in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    whole = pairs.join(texts.select(F.col("key").alias("a"), "text"), "a").join(
        texts.select(F.col("key").alias("b"), F.col("text").alias("other")), "b"
    )
    return whole.select("a", "b", "text", "other").mapInArrow(run, "a long, b long")


def _room(similarity: float) -> Column:
    """Whether two sets that share the shingle at these places can be similar."""
    at, other = F.col("place"), F.col("place_b")
    most = F.least(at, other) + 1 + F.least(F.col("n") - at, F.col("n_b") - other) - 1
    return most * (1 + similarity) >= similarity * (F.col("n") + F.col("n_b")) - 1e-6


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = SHINGLE, similarity: float = SIMILARITY
) -> DataFrame:
    """``id_col, component``: the smallest id that links between similar texts can reach.

    One row for each row of ``docs``. Texts of fewer words than a shingle are one
    shingle; texts without words, NULL among them, are alike. A NULL id links others, but
    is no one's smallest id.
    """
    worded = F.coalesce(F.col(text).rlike(r"[^ \t\n\x0B\f\r]"), F.lit(False))
    rows = docs.select(id_col, F.when(worded, F.xxhash64(text)).otherwise(F.lit(0)).alias("key"), F.col(text).alias("text"))
    marked = rows.select(id_col, "key")
    texts = rows.where(worded).select("key", "text")
    # A text's copies have the same shingles.
    found = _prefixes(texts, size, similarity).distinct()
    shared = found.groupBy("shingle").agg(F.count("*").alias("texts"), F.min("key").alias("head")).where("texts > 1")
    members = shared_table(found.join(shared, "shingle").drop("texts"))
    wanted = members.select("key").distinct()
    whole = shared_table(texts.join(wanted, "key", "left_semi").groupBy("key").agg(F.min("text").alias("text")))
    head = members.where("key = head").select("shingle", F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("place").alias("place_b"))
    star = members.where("key <> head").select("shingle", F.col("key").alias("a"), "n", "place").join(head, "shingle")
    links = shared_table(_similar(star.where(_room(similarity)).select("a", "b").distinct(), whole, size, similarity))
    classes = components(links).withColumnRenamed("node", "key")
    members = shared_table(
        members.join(classes, "key", "left").select("shingle", "key", "n", "place", F.coalesce("component", "key").alias("class"))
    )
    mixed = members.groupBy("shingle").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high")
    rest = shared_table(members.join(mixed.select("shingle"), "shingle"))
    left = rest.select("shingle", F.col("key").alias("a"), "n", "place", "class")
    right = rest.select(
        "shingle", *(F.col(c).alias(d) for c, d in (("key", "b"), ("n", "n_b"), ("place", "place_b"), ("class", "class_b")))
    )
    more = left.join(right, "shingle").where((F.col("a") < F.col("b")) & (F.col("class") != F.col("class_b")) & _room(similarity))
    more = _similar(more.select("a", "b").distinct(), whole, size, similarity)
    classes = components(links.unionByName(more)).withColumnRenamed("node", "key")
    classed = shared_table(
        marked.join(classes, "key", "left").select(id_col, F.coalesce("component", "key").alias("class"))
    )
    smallest = shared_table(classed.groupBy("class").agg(F.min(id_col).alias("component")))
    return classed.join(smallest, "class").select(id_col, "component")
