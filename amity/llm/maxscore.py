"""Exact top-k by inner product with MaxScore.

A vector is a document whose terms are its components: term ``d`` has weight
``x[d]``, and a query weighs the term with ``q[d]``. Rows are dealt to shards.
In a shard each term has the bounds of its weights, so a query knows the least
and the most that the term can add. Impacts are counted from the least, which
makes them non-negative, negative weights included.

For each query the terms are put in order of their bounds. The longest run of
small terms whose bounds together stay below the threshold is non-essential: no
row becomes competitive by those alone. The essential terms' postings are
traversed and summed. Then the others are probed, the largest first, only for
rows whose sum with all remaining bounds still reaches the threshold, which
rises with the k-th best sum so far. Rows that tie with the threshold stay in,
so ties can be told apart by id. The shards' lists are merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 8192
QUERY_BLOCK = 4096


def integer_components(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, as bigint; NULL for a vector that is NULL or holds a
    NULL, NaN or infinite component."""
    finite = F.forall(
        vector,
        lambda x: F.coalesce(
            x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)
        ),
    )
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return F.when(finite, scaled)


def search_shard(
    rows: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each query: its id repeated, and the ids and scores of the ``k`` best rows of the shard."""
    low, high = rows.min(axis=0), rows.max(axis=0)
    postings = np.ascontiguousarray(rows.T)
    for q, query_id in zip(queries, query_ids, strict=True):
        ends = np.stack([q * low, q * high])
        least, bound = ends.min(axis=0), np.abs(ends[0] - ends[1])
        order = np.argsort(-bound, kind="stable")
        left = np.concatenate([np.cumsum(bound[order][::-1])[::-1], [0]])  # from the i-th term on
        own = ids == query_id
        if len(ids) - own.sum() <= 0:
            continue
        keep = min(k, len(ids) - int(own.sum()))
        # The threshold starts as the k-th best of the rows that lead on the heaviest terms.
        head = order[:8]
        lead = q[head] @ postings[head]
        lead[own] = np.iinfo(np.int64).min + 1  # its negative is a number too
        first = np.argpartition(-lead, keep - 1)[:keep] if keep < len(lead) else np.arange(len(lead))
        first = first[~own[first]]
        threshold = (rows[first] @ q - least.sum()).min() if len(first) >= keep else 0
        essential = int(np.searchsorted(-left, -threshold, side="right"))  # left[essential] < threshold
        essential = max(1, min(essential, len(order)))
        terms = order[:essential]
        total = q[terms] @ postings[terms] - least[terms].sum()
        alive = np.flatnonzero(~own & (total + left[essential] >= threshold))
        total = total[alive]
        for i in range(essential, len(order)):
            total = total + q[order[i]] * postings[order[i], alive] - least[order[i]]
            if len(alive) > 4 * keep and (i - essential) % 4 == 3:
                threshold = max(threshold, np.partition(total, len(total) - keep)[len(total) - keep])
                stay = total + left[i + 1] >= threshold
                alive, total = alive[stay], total[stay]
        best = np.lexsort((ids[alive], -total))[:keep]
        yield np.full(len(best), query_id), ids[alive[best]], total[best] + least.sum()


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    n_rows: int,
    n_queries: int,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "vector",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best rows but those of its own id.

    ``vector_col`` holds bigint components; NULL vectors and NULL ids take no
    part. Vectors of other lengths count as filled up with zeros. Equal scores
    rank by smaller id; rows that repeat an id are rows of their own, queries that
    repeat one are one query (the greatest vector). An empty side gives an empty
    result.

    ``n_rows`` and ``n_queries`` are the sizes, or guesses: they set the numbers
    of shards and blocks, not the result. Each shard meets the stated query set
    block by block, one shard and one block a task. Rows that repeat both id and
    vector are counted first, as no more than ``k`` of them can be in a list. Of
    each shard and query ``k`` rows are left for the merge.
    """
    shards, blocks = max(1, -(-n_rows // shard_rows)), max(1, -(-n_queries // QUERY_BLOCK))

    def usable(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(
            "id IS NOT NULL AND v IS NOT NULL"
        )

    def part(n: int, seed: int) -> Column:
        return F.pmod(F.xxhash64("id", "v", F.lit(seed)), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    dealt = (
        usable(vectors)
        .groupBy("id", "v")
        .agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("copies"))
        .withColumns({"shard": part(shards, 1), "block": every(blocks)})
    )
    asked = usable(queries).groupBy("id").agg(F.max("v").alias("v")).withColumns({"block": part(blocks, 2), "shard": every(shards)})

    def matrix(column: pd.Series, width: int) -> np.ndarray:
        out = np.zeros((len(column), width), np.int64)
        for i, v in enumerate(column):
            out[i, : len(v)] = v
        return out

    def search(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(asked):
            width = max(rows["v"].map(len).max(), asked["v"].map(len).max(), 1)
            rows = rows.loc[rows.index.repeat(rows["copies"])]
            data, ids = matrix(rows["v"], width), rows["id"].to_numpy()
            found = list(search_shard(data, ids, matrix(asked["v"], width), asked["id"].to_numpy(), k))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] or [np.array([], np.int64)] * 3
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    best = (
        dealt.groupBy("shard", "block")
        .cogroup(asked.groupBy("shard", "block"))
        .applyInPandas(search, "query_id long, vec_id long, score long")
    )
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
