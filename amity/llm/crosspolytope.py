"""Approximate nearest neighbours by inner product, with cross-polytope hashing.

A hash turns a unit vector by a pseudo-random rotation, three rounds of random signs and a Hadamard
transform, and takes the nearest signed axis. A table's bucket is the axes of one such hash or more;
the last may look at the first few coordinates only, so that there are about ``BUCKET_ROWS`` rows a
bucket however many rows there are. There are ``TABLES`` tables, and every row lies in a bucket of each.

A query probes buckets of all tables in the order of their promise. A neighbour's coordinate on an
axis grows with the query's own, so the promise is the sum of the query's coordinates on the
bucket's axes, each weighed by how far out the greatest of so many coordinates usually lies. All
buckets down to one threshold are probed. The threshold is fitted: of at most ``SAMPLE`` queries the
true neighbours among all rows are found, and for each the promise of its most promising bucket; a share
of ``RECALL`` of these has to reach the threshold. All rows found are ranked by their exact inner product. A query that
finds fewer than asked for is searched again, in all buckets of a table, which hold all rows.

Rows and queries meet by bucket. Buckets are dealt to cells of about ``CELL_ROWS`` rows, and a query
goes once to each cell that has one of its buckets. A cell with a large bucket is cut by row, and its
queries visit all cuts; one with very many queries gets them in parts. So no task holds more than
about one cell and one part of queries, however the rows lie. Which cells are that large is written
to the shared folder and joined by the size of the file.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amity.llm.tables import shared_table

TABLES = 8
BUCKET_ROWS = 128
SAMPLE = 256
RECALL = 0.95
CELL_ROWS = 32768
CELL_QUERIES = 8192
#: Pairs that a cell holds before it cuts them to each query's best.
HELD_PAIRS = 1 << 20
ROUNDS = 3


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthogonal Walsh-Hadamard transform of the rows, whose length is a power of 2."""
    n, half = x.shape[1], 1
    while half < n:
        pairs = x.reshape(len(x), -1, 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        half *= 2
    return x / np.sqrt(n)


class CrossPolytope:
    """The hashes of all tables, for vectors of ``width`` components, among ``n_rows`` rows."""

    def __init__(self, width: int, n_rows: int, tables: int = TABLES, seed: int = 13) -> None:
        self.width, self.tables = max(1, width), tables
        self.dims = 1 << (self.width - 1).bit_length()
        #: Coordinates that each hash of a table looks at; there are twice as many axes.
        self.looks = [self.dims]
        buckets = 2 * self.dims
        while buckets * BUCKET_ROWS < n_rows:
            more = -(-n_rows // (buckets * BUCKET_ROWS))
            look = min(self.dims, 1 << max(0, (more - 1).bit_length() - 1))
            self.looks.append(look)
            buckets *= 2 * look
        self.buckets = buckets
        signs = np.random.default_rng(seed).integers(0, 2, (tables, len(self.looks), ROUNDS, self.dims))
        self.signs = signs * 2.0 - 1.0

    def promises(self, vectors: np.ndarray, table: int) -> list[np.ndarray]:
        """For each hash of the table, the promise of each signed axis."""
        unit = np.zeros((len(vectors), self.dims))
        # Scaled first, so that no square overflows or vanishes.
        scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        unit[:, : self.width] = scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))
        out = []
        for look, rounds in zip(self.looks, self.signs[table], strict=True):
            turned = unit
            for signs in rounds:
                turned = hadamard(turned * signs)
            out.append(np.hstack([turned[:, :look], -turned[:, :look]]) * np.sqrt(np.log(2 * look)))
        return out

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """The bucket of each vector in each table, numbered through all tables."""
        out = np.empty((len(vectors), self.tables), np.int64)
        for t in range(self.tables):
            code = np.zeros(len(vectors), np.int64)
            for axes in self.promises(vectors, t):
                code = code * axes.shape[1] + axes.argmax(axis=1)
            out[:, t] = code + t * self.buckets
        return out

    def promise_of(self, vectors: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """For each vector and its row of ``codes``, the greatest promise of these buckets."""
        best = np.full(len(vectors), -np.inf)
        for t in range(self.tables):
            code, total = codes[:, t] - t * self.buckets, 0.0
            for axes in reversed(self.promises(vectors, t)):
                code, axis = np.divmod(code, axes.shape[1])
                total = total + axes[np.arange(len(axes)), axis]
            best = np.maximum(best, total)
        return best

    def probes(self, vectors: np.ndarray, threshold: float) -> list[np.ndarray]:
        """For each vector the buckets whose promise reaches the threshold, and its own in each table."""
        own = self.codes(vectors)
        found = [[own[i]] for i in range(len(vectors))]
        for t in range(self.tables):
            hashes = self.promises(vectors, t)
            for i in range(len(vectors)):
                rest = sum(axes[i].max() for axes in hashes)
                code, total = np.zeros(1, np.int64), np.zeros(1)
                for axes in hashes:
                    rest -= axes[i].max()
                    total = (total[:, None] + axes[i]).ravel()
                    code = (code[:, None] * axes.shape[1] + np.arange(axes.shape[1])).ravel()
                    near = total + rest >= threshold
                    code, total = code[near], total[near]
                found[i].append(code + t * self.buckets)
        return [np.unique(np.concatenate(f)) for f in found]


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of doubles, shorter ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows, summed up from the first component to the last wherever they are computed."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def _candidates(asked: np.ndarray, rows: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that hold each asked vector's ``k`` best rows, and those too near to tell by a matrix
    product, whose sums may differ in their last bits. ``own`` marks pairs that don't count."""
    with np.errstate(over="ignore", invalid="ignore"):
        near = asked @ rows.T
    near[np.isnan(near)] = np.inf  # sums beyond all doubles are told apart later
    near[own] = -np.inf
    if len(rows) > k:
        sizes = np.sqrt((asked**2).sum(axis=1)) * np.sqrt((rows**2).sum(axis=1).max())
        least = np.partition(near, len(rows) - k, axis=1)[:, len(rows) - k]
        with np.errstate(invalid="ignore"):
            stay = ~(near < (least - 1e-13 * asked.shape[1] * sizes)[:, None])
    else:
        stay = np.ones_like(near, bool)
    return np.nonzero(stay & ~own)


def _best(query: np.ndarray, row: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's ``k`` best pairs of different (score, id), best first."""
    order = np.lexsort((row, -score, query))
    q, r, s = query[order], row[order], score[order]
    new = np.ones(len(q), bool)
    new[1:] = (q[1:] != q[:-1]) | (r[1:] != r[:-1]) | (s[1:] != s[:-1])
    order, q = order[new], q[new]
    start = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    return order[rank < k]


FOUND = "query_id bigint, vec_id bigint, score double"


def _found(query: np.ndarray, row: np.ndarray, score: np.ndarray) -> dict[str, pa.Array]:
    return {"query_id": pa.array(query, pa.int64()), "vec_id": pa.array(row, pa.int64()), "score": pa.array(score, pa.float64())}


class Held:
    """Pairs found so far, cut to each query's best whenever there are many."""

    def __init__(self, k: int) -> None:
        self.k, self.parts, self.size = k, [], 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.size += len(columns[0])
        if self.size > HELD_PAIRS:
            self.best()
            self.size = 0  # what is left counts no more: it is needed in any case

    def best(self) -> list[np.ndarray]:
        """Query, row and score, and what else was added, of the best."""
        if not self.parts:
            return []
        columns = [np.concatenate(c) for c in zip(*self.parts, strict=True)]
        stay = _best(*columns[:3], self.k)
        self.parts = [tuple(c[stay] for c in columns)]
        return list(self.parts[0])


def _of_sample(
    batches: Iterator[pa.RecordBatch], hashes: CrossPolytope, ids: np.ndarray, asked: np.ndarray, k: int
) -> Iterator[pa.RecordBatch]:
    """The true neighbours of the sample within the task, with the promise of their best bucket."""
    held = Held(k)
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            part = batch.slice(start, 4096)
            rows, row_ids = _matrix(part.column("v"), hashes.width), part.column("id").to_numpy()
            q, r = _candidates(asked, rows, ids[:, None] == row_ids, k)
            score = _exact(asked[q], rows[r])
            stay = _best(q, row_ids[r], score, k)
            q, r, score = q[stay], r[stay], score[stay]
            held.add(q, row_ids[r], score, hashes.promise_of(asked[q], hashes.codes(rows[r])) if len(q) else score)
    best = held.best() or [np.zeros(0)] * 4
    columns = _found(best[0].astype(np.int64), best[1].astype(np.int64), best[2]) | {"promise": pa.array(best[3], pa.float64())}
    yield pa.RecordBatch.from_pydict(columns)


def fit_threshold(rows: DataFrame, queries: DataFrame, hashes: CrossPolytope, k: int) -> float:
    """The promise down to which queries probe. The sample are the queries whose ids hash lowest."""
    sample = queries.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    if not sample.num_rows:
        return -np.inf
    ids, asked = sample["id"].to_numpy(), _matrix(sample["v"], hashes.width)
    near = rows.mapInArrow(partial(_of_sample, hashes=hashes, ids=ids, asked=asked, k=k), f"{FOUND}, promise double")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # The neighbours of the sample: at most SAMPLE * k numbers.
    true = near.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("promise").collect()
    promise = np.sort([r["promise"] for r in true])
    return float(promise[int((1 - RECALL) * len(promise))]) if len(promise) else -np.inf


def _cell(codes: np.ndarray, cells: int) -> np.ndarray:
    """The cell of each bucket; multiplied, as neighbouring buckets may be alike in size."""
    return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(cells)


def _row_codes(batches: Iterator[pa.RecordBatch], hashes: CrossPolytope, cells: int) -> Iterator[pa.RecordBatch]:
    """Rows with the buckets, and the buckets' cells, that they lie in."""
    for batch in batches:
        codes = hashes.codes(_matrix(batch.column("v"), hashes.width)) if batch.num_rows else np.zeros((0, hashes.tables), np.int64)
        places = pa.StructArray.from_arrays(
            [pa.array(codes.ravel()), pa.array(_cell(codes, cells).astype(np.int32).ravel())], ["code", "cell"]
        )
        offsets = pa.array(np.arange(len(codes) + 1, dtype=np.int32) * hashes.tables)
        yield pa.RecordBatch.from_pydict(dict(zip(batch.schema.names, batch.columns, strict=True)) | {"places": pa.ListArray.from_arrays(offsets, places)})


def _query_codes(
    batches: Iterator[pa.RecordBatch], hashes: CrossPolytope, threshold: float, cells: int
) -> Iterator[pa.RecordBatch]:
    """A row for each query and cell, with the buckets that the query probes there."""
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            owner, cell_of, codes = [], [], []
            for i, probed in enumerate(hashes.probes(_matrix(part.column("v"), hashes.width), threshold)):
                there = _cell(probed, cells)
                order = np.argsort(there, kind="stable")
                cell, first = np.unique(there[order], return_index=True)
                owner += [i] * len(cell)
                cell_of.append(cell.astype(np.int32))
                codes += np.split(probed[order], first[1:])
            yield pa.RecordBatch.from_pydict({
                "id": part.column("id").take(pa.array(owner)),
                "v": part.column("v").take(pa.array(owner)),
                "cell": pa.array(np.concatenate(cell_of)),
                "codes": pa.array(codes, pa.list_(pa.int64())),
            })


def _search_cell(rows: pa.Table, asked: pa.Table, width: int, k: int) -> pa.Table:
    held = Held(k)
    if rows.num_rows and asked.num_rows:
        data, ids, code = _matrix(rows["v"], width), rows["id"].to_numpy(), rows["code"].to_numpy()
        order = np.argsort(code, kind="stable")
        data, ids = data[order], ids[order]
        buckets, start = np.unique(code[order], return_index=True)
        end = np.append(start[1:], len(code))
        query, query_ids = _matrix(asked["v"], width), asked["id"].to_numpy()
        wanted = asked["codes"].combine_chunks()
        owner = np.repeat(np.arange(len(query)), pc.list_value_length(wanted).to_numpy())
        bucket = wanted.flatten().to_numpy()
        owner = owner[np.argsort(bucket, kind="stable")]
        probed, first = np.unique(np.sort(bucket), return_index=True)
        last = np.append(first[1:], len(bucket))
        place = np.minimum(np.searchsorted(buckets, probed), len(buckets) - 1)
        there = buckets[place] == probed
        for p, f, to in zip(place[there], first[there], last[there], strict=True):
            here = slice(start[p], end[p])
            for at in range(f, to, 512):
                who = owner[at : min(to, at + 512)]
                q, r = _candidates(query[who], data[here], query_ids[who][:, None] == ids[here], k)
                q, r = who[q], r + start[p]
                held.add(query_ids[q], ids[r], _exact(query[q], data[r]))
    return pa.table(_found(*(held.best() or [[], [], []])))


def _search(rows: DataFrame, queries: DataFrame, hashes: CrossPolytope, threshold: float, n_rows: int, k: int) -> DataFrame:
    kind = dict(rows.dtypes)["v"]
    cells = max(1, -(-hashes.tables * n_rows // CELL_ROWS))
    place = partial(_row_codes, hashes=hashes, cells=cells)
    places = "places array<struct<code:bigint,cell:int>>"
    dealt = rows.mapInArrow(place, f"id bigint, v {kind}, {places}").select("id", "v", F.inline("places"))
    asked = queries.mapInArrow(
        partial(_query_codes, hashes=hashes, threshold=threshold, cells=cells),
        f"id bigint, v {kind}, cell int, codes array<bigint>",
    )
    # Cells with more than their share of rows or of queries are cut into a grid of both.
    counted = dealt.groupBy("cell").agg(F.count("*").alias("n"), F.lit(0).cast("bigint").alias("m")).unionByName(
        asked.groupBy("cell").agg(F.lit(0).cast("bigint").alias("n"), F.count("*").alias("m"))
    ).groupBy("cell").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    grid = shared_table(
        counted.select(
            "cell",
            F.greatest(F.ceil(F.col("n") / (2 * CELL_ROWS)), F.lit(1)).cast("int").alias("cuts"),
            F.greatest(F.ceil(F.col("m") / CELL_QUERIES), F.lit(1)).cast("int").alias("crowds"),
        ).where("cuts > 1 OR crowds > 1")
    )
    cuts, crowds = F.coalesce("cuts", F.lit(1)), F.coalesce("crowds", F.lit(1))

    def every(n: Column, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1)).alias(name)

    def one_of(n: Column, name: str) -> Column:
        return F.pmod(F.xxhash64("id"), n).cast("int").alias(name)

    keys = ["cell", "cut", "crowd"]
    dealt = dealt.join(grid, "cell", "left").select("cell", one_of(cuts, "cut"), every(crowds, "crowd"), "id", "v", "code")
    asked = asked.join(grid, "cell", "left").select("cell", every(cuts, "cut"), one_of(crowds, "crowd"), "id", "v", "codes")

    def search(some: pa.Table, wanted: pa.Table) -> pa.Table:
        return _search_cell(some, wanted, hashes.width, k)

    found = dealt.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, FOUND)
    # A row that a query finds in several tables has the same rank each time.
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.dense_rank().over(ranked)).where(F.col("rank") <= k)
    return best.dropDuplicates(["query_id", "rank"]).select("query_id", "rank", "vec_id", "score")


def neighbours(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query about its ``k`` rows of the greatest inner
    product (in double precision, summed up from the first component), but none of its own id.

    All ``k`` are there if there are as many other rows; which ones is approximate, what each scores is
    exact. Equal scores rank by smaller id. NULL ids, and vectors that are NULL, empty or all zero, or
    hold a NULL, NaN or infinite component, take no part. Shorter vectors count as filled up with
    zeros. An id of several vectors is listed for each that scores differently; as a query it is one,
    by its greatest vector. Other columns are not looked at. Empty tables give an empty result.

    Of rows with the same vector only the ``k + 1`` smallest ids can be in any list; the others leave
    first, so that a vector copied very often is no hot bucket. ``rows`` are written once to the
    shared folder, as they are read for the fit, for the sizes of buckets and for the search.
    """

    def usable(df: DataFrame) -> DataFrame:
        zero = F.forall("v", lambda x: x == 0)
        finite = F.forall("v", lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
        return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("v")).where(
            F.col("id").isNotNull() & finite & ~zero
        )

    copies = Window.partitionBy("v").orderBy("id")
    kept = usable(vectors).withColumn("copy", F.dense_rank().over(copies)).where(F.col("copy") <= k + 1)
    rows = shared_table(kept.select("id", "v"))
    asked = shared_table(usable(queries).groupBy("id").agg(F.max("v").alias("v")))
    size = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    width = max(size[1] or 1, asked.agg(F.max(F.size("v"))).first()[0] or 1)
    hashes = CrossPolytope(width, size[0])
    found = shared_table(_search(rows, asked, hashes, fit_threshold(rows, asked, hashes, k), size[0], k))
    full = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"))
    short = asked.join(full, "id", "left_anti")
    if short.isEmpty():
        return found
    short = shared_table(short)
    again = _search(rows, short, CrossPolytope(width, size[0], tables=1), -np.inf, size[0], k)
    return found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(again)
