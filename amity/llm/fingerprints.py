"""Document fingerprints from prefix polynomial hashes.

A text's prefix array holds, modulo two primes, the sum of ``c[j] * B**j`` over
the code points before each place. The difference of two entries, brought to
the same power, is the hash of the span between them. So any two spans are
compared in constant time, and the longest common extension of two places is
found by binary search.

A fingerprint is the hash of the whole text and the ``SKETCH`` least mixed
hashes of its spans of ``SPAN`` code points, repeats counted once. The least
values of the union of two texts are a fair draw from their spans, which gives
the likeness of two fingerprints without their texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPAN = 12
SKETCH = 64
PRIMES = np.array([2147483647, 2147483629], np.uint64)
BASES = np.array([911382323, 972663749], np.uint64)


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(max(1, n), np.uint64)
    done = 1
    while done < n:
        step = min(done, n - done)
        factor = np.uint64(pow(base, done, prime))
        out[done : done + step] = out[:step] * factor % np.uint64(prime)
        done += step
    return out


class _Powers:
    """Powers of the bases and of their inverses, as many as the longest text so far needs."""

    up = [np.ones(1, np.uint64)] * 2
    down = [np.ones(1, np.uint64)] * 2

    @classmethod
    def upto(cls, n: int) -> None:
        if len(cls.up[0]) < n:
            n = max(n, 2 * len(cls.up[0]))
            pairs = [(int(b), int(p)) for b, p in zip(BASES, PRIMES, strict=True)]
            cls.up = [_powers(b, p, n) for b, p in pairs]
            cls.down = [_powers(pow(b, -1, p), p, n) for b, p in pairs]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class PrefixHashes:
    """The prefix arrays of one text (its code points)."""

    def __init__(self, points: np.ndarray):
        self.n = len(points)
        _Powers.upto(self.n + 1)
        values = points.astype(np.uint64) + np.uint64(1)
        self.sums = []
        for up, prime in zip(_Powers.up, PRIMES, strict=True):
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(values * up[: self.n] % prime, out=sums[1:])  # below 2**31 each
            self.sums.append(sums % prime)

    def spans(self, starts: np.ndarray | slice, ends: np.ndarray | slice) -> np.ndarray:
        """62-bit hashes of the spans from ``starts`` to before ``ends``."""
        parts = [
            (sums[ends] + prime - sums[starts]) % prime * down[starts] % prime
            for sums, down, prime in zip(self.sums, _Powers.down, PRIMES, strict=True)
        ]
        return parts[0] << np.uint64(31) | parts[1]

    def span(self, start: int, end: int) -> int:
        return int(self.spans(slice(start, start + 1), slice(end, end + 1))[0])

    def every(self, width: int) -> np.ndarray:
        """The hashes of all spans of one width."""
        return self.spans(slice(0, self.n + 1 - width), slice(width, self.n + 1))


def common_extension(a: PrefixHashes, i: int, b: PrefixHashes, j: int) -> int:
    """How many code points agree from place ``i`` of one text and ``j`` of the other."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        middle = (low + high + 1) // 2
        if a.span(i, i + middle) == b.span(j, j + middle):
            low = middle
        else:
            high = middle - 1
    return low


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def sketch(points: np.ndarray, span: int = SPAN, size: int = SKETCH) -> np.ndarray:
    """The hash of the whole text, then the least mixed span hashes in order. A text shorter than
    a span is one span; the empty text has none."""
    hashes = PrefixHashes(points)
    if not hashes.n:
        return np.zeros(1, np.uint64)
    mixed = _mixed(hashes.every(min(span, hashes.n)))
    draw = 4 * size
    while True:  # repeats may fill a draw
        least = np.unique(np.partition(mixed, draw)[:draw] if draw < len(mixed) else mixed)
        if len(least) >= size or draw >= len(mixed):
            break
        draw *= 8
    return np.concatenate([[np.uint64(hashes.span(0, hashes.n))], least[:size]])


def as_text(values: np.ndarray) -> str:
    return values.astype(">u8").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, size: int = SKETCH) -> float:
    """Share of common spans, twice the common ones over all of both (0 to 1), as drawn."""
    if a[0] == b[0] and len(a) == len(b) and (a == b).all():
        return 1.0
    union = np.union1d(a[1:], b[1:])[:size]
    if not len(union):
        return 0.0
    both = len(np.intersect1d(np.intersect1d(a[1:], b[1:]), union))
    return 2 * both / (len(union) + both)


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each whole text in place of the text; NULL counts as
    empty. No shuffle."""
    others = [c for c in docs.columns if c not in (text, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [as_text(sketch(code_points(v.as_py() or ""))) for v in batch.column(len(others))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string())], [*others, out])

    schema = T.StructType([docs.schema[c] for c in others] + [T.StructField(out, T.StringType())])
    return docs.select(*others, text).mapInArrow(run, schema)


def edited_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", ranges: int | None = None
) -> DataFrame:
    """Each text against its edited form and against the next text.

    Columns: ``id_col``, ``n_chars`` (code points), ``edited_text``,
    ``fingerprint``, ``edited_fingerprint``, and the likeness of the first to the
    second (``near_edited``) and to the next text's fingerprint (``near_next``).

    The last half of a text is replaced by as many first code points of the next
    one in descending order of id (equal ids by text; a NULL id comes last;
    after the last document comes the first). NULL texts are empty, a lone
    document follows itself, equal rows follow each other.

    Documents are dealt by ranges of ids, so each text is shuffled once. The
    first document of a range is also sent to the range before. Only the bounds
    and first ids of the ranges, one number each, pass through the driver;
    ``ranges`` defaults to the session's number of shuffle partitions. A range
    is read in order, batch by batch.
    """
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    shares = [i / ranges for i in range(1, ranges)]
    found = rows.agg(F.percentile_approx("id", shares).alias("b")).first()["b"] if shares else None
    bounds = np.array(sorted(set(found or [])), np.int64)
    last = len(bounds) + 1  # the range of NULL ids

    @F.arrow_udf("int")
    def range_of(ids: pa.Array) -> pa.Array:
        place = len(bounds) - np.searchsorted(bounds, ids.fill_null(0).to_numpy(), side="left")
        return pa.array(np.where(ids.is_null().to_numpy(False), last, place), pa.int32())

    placed = rows.select(range_of("id").alias("part"), "id")
    firsts = sorted(tuple(r) for r in placed.groupBy("part").agg(F.max("id")).collect())
    before = {top: firsts[i - 1][0] for i, (_, top) in enumerate(firsts)}  # the range before, by first id

    @F.arrow_udf("int")
    def range_before(ids: pa.Array) -> pa.Array:
        return pa.array([before.get(i) for i in ids.to_pylist()], pa.int32())

    dealt = (
        rows.withColumns({"own": range_of("id"), "other": range_before("id")})
        .withColumn("to", F.array_compact(F.array(
            F.struct(F.col("own").alias("part"), F.lit(False).alias("follows")),
            F.when(F.col("other").isNotNull(), F.struct(F.col("other").alias("part"), F.lit(True).alias("follows"))),
        )))
        .select("id", "text", F.explode("to").alias("to"))
        .select("to.part", "to.follows", "id", "text")
        .repartitionById(len(bounds) + 2, F.col("part"))
        .sortWithinPartitions("part", "follows", F.desc_nulls_last("id"), "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, out = None, []
        for batch in batches:
            for part, follows, key, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                points = code_points(value)
                row = (part, key, value, points, sketch(points))
                if before is not None and before[0] == part:
                    out.append(_pair(before, row))
                # What follows a range is only looked at once.
                before = None if follows else row
            yield pa.RecordBatch.from_pylist(out, PAIRS)
            out = []

    return dealt.mapInArrow(run, PAIRS_SQL).withColumnRenamed("id", id_col).withColumn(
        id_col, F.col(id_col).cast(kind)
    )


PAIRS = pa.schema([
    ("id", pa.int64()), ("n_chars", pa.int64()), ("edited_text", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
PAIRS_SQL = (
    "id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def _pair(row: tuple, following: tuple) -> dict:
    _, key, text, points, own = row
    half = len(points) // 2
    edited = text[: len(text) - half] + following[2][:half]
    changed = sketch(np.concatenate([points[: len(points) - half], following[3][:half]]))
    return {
        "id": key, "n_chars": len(points), "edited_text": edited, "fingerprint": as_text(own),
        "edited_fingerprint": as_text(changed), "near_edited": likeness(own, changed),
        "near_next": likeness(own, following[4]),
    }
