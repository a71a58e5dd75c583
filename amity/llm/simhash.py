"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints within ``distance`` bits are linked. The 64 bits are cut into
``distance + 2`` blocks; two linked fingerprints agree on two blocks at least, so
each pair of blocks is one projection, and a bucket of it holds the fingerprints
with the same two blocks. Equal fingerprints are one from the start.

A bucket is searched with a tree. Its fingerprints are sorted by Gray rank, so
that neighbours differ in few bits. Runs of them are the leaves, and every upper
node keeps the bit pattern that all its members share, with the mask of the
shared bits. Two nodes differ at least in the bits where both masks hold and the
patterns disagree; pairs of nodes with more than ``distance`` such bits are
pruned as a whole, and a node whose members cannot differ in more than
``distance`` bits is linked as a whole. Only a spanning set of links leaves a
bucket, never all of its pairs.

Buckets above ``LARGE`` members are cut along the Gray order into runs, by
quantiles, and pairs of runs are searched as tasks of their own, again only those
whose shared patterns leave room for a link.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amity.llm.components import components
from amity.llm.tables import shared_table

SEED = 42
SHINGLE = 4
DISTANCE = 4
LARGE = 4096
LEAF = 16
FANOUT = 8
DRAW = 16


def shingle_hashes(text: str, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of the word shingles of a text in lower case (A to Z only), repeats included."""
    words = text.encode().lower().split()  # bytes split at ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=starts[1:])
    count = max(1, len(words) - size + 1)
    begins = starts[:count].tolist()
    ends = (starts[-count:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[b:e], SEED) for b, e in zip(begins, ends, strict=True)), np.uint64, count)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes; zero for none."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):  # long texts in pieces
        part = hashes[at : at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with a 64-bit fingerprint (as signed bigint) in place of the text; NULL counts as
    empty, whose fingerprint is zero. Whole texts, no shuffle."""
    others = [c for c in docs.columns if c not in (text, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(shingle_hashes(v.as_py() or "")) for v in batch.column(len(others))]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(signed, pa.int64())], [*others, out])

    schema = T.StructType([docs.schema[c] for c in others] + [T.StructField(out, T.LongType())])
    return docs.select(*others, text).mapInArrow(run, schema)


def gray_rank(values: np.ndarray) -> np.ndarray:
    """The place of each value in the reflected Gray code."""
    out = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


def gray_rank_column(value: Column) -> Column:
    """As ``gray_rank``, shifted so that its order as a signed number is the same."""
    for shift in (1, 2, 4, 8, 16, 32):
        value = value.bitwiseXOR(F.shiftrightunsigned(value, shift))
    return value.bitwiseXOR(F.lit(-(1 << 63)))


def block_masks(distance: int) -> list[int]:
    """The masks of the pairs of blocks; each has about 2 * 64 / (distance + 2) bits."""
    cuts = [round(i * 64 / (distance + 2)) for i in range(distance + 3)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    return [x | y for x, y in combinations(blocks, 2)]


class GrayTree:
    """The index of one sorted run: per level the bits all members of a node have set, and have
    set or not (and, or), from the leaves up."""

    def __init__(self, values: np.ndarray):
        self.values = values[np.argsort(gray_rank(values), kind="stable")]
        self.levels = [(self.values, self.values)]
        width = LEAF
        while len(self.levels[-1][0]) > 1:
            every, some = self.levels[-1]
            starts = np.arange(0, len(every), width)
            self.levels.append((np.bitwise_and.reduceat(every, starts), np.bitwise_or.reduceat(some, starts)))
            width = FANOUT


def _children(parents: np.ndarray, width: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """For each parent its children; and which parent each is of."""
    first = parents * width
    number = np.minimum(first + width, count) - first
    of = np.repeat(np.arange(len(parents)), number)
    return first[of] + np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number), of


class Forest:
    """Union of places, of which only the joining links are kept."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a) > 32:  # most are joined already
            while (next_root := self.root[self.root]).tobytes() != self.root.tobytes():
                self.root = next_root
            fresh = self.root[a] != self.root[b]
            a, b = a[fresh], b[fresh]
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            x, y = self.find(i), self.find(j)
            if x != y:
                self.root[max(x, y)] = min(x, y)
                self.links.append((i, j))


def spanning_links(left: np.ndarray, right: np.ndarray | None, distance: int) -> list[tuple[int, int]]:
    """Links that connect whatever is within ``distance``: inside ``left``, or between the two."""
    a = GrayTree(left)
    b = a if right is None else GrayTree(right)
    forest = Forest(len(a.values) + (0 if right is None else len(b.values)))
    shift = 0 if right is None else len(a.values)
    widths = [LEAF] + [FANOUT] * 64
    top_a, top_b = len(a.levels) - 1, len(b.levels) - 1
    stack = [(top_a, top_b, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        la, lb, i, j = stack.pop()
        every_a, some_a = (x[i] for x in a.levels[la])
        every_b, some_b = (x[j] for x in b.levels[lb])
        least = np.bitwise_count((every_a & ~some_b) | (every_b & ~some_a))
        near = least <= distance
        i, j = i[near], j[near]
        if not len(i):
            continue
        every, some = every_a[near] & every_b[near], some_a[near] | some_b[near]
        if la == 0 and lb == 0:
            forest.join(i, j + shift)
            continue
        # All members of both nodes are near each other: a star instead of their pairs.
        close = np.bitwise_count(every ^ some) <= distance
        for x, y in zip(i[close].tolist(), j[close].tolist(), strict=True):
            spans = []
            for tree, level, node, add in ((a, la, x, 0), (b, lb, y, shift)):
                size = int(np.prod(widths[:level], dtype=np.int64)) if level else 1
                spans.append(np.arange(node * size, min((node + 1) * size, len(tree.values))) + add)
            members = np.unique(np.concatenate(spans))
            forest.join(np.full(len(members) - 1, members[0]), members[1:])
        i, j = i[~close], j[~close]
        if not len(i):
            continue
        # The higher node is opened; of two equal ones both, one after the other.
        if la >= lb:
            child, of = _children(i, widths[la - 1], len(a.levels[la - 1][0]))
            pair = (la - 1, lb, child, j[of])
        else:
            child, of = _children(j, widths[lb - 1], len(b.levels[lb - 1][0]))
            pair = (la, lb - 1, i[of], child)
        if right is None and pair[0] == pair[1]:
            keep = pair[2] <= pair[3]  # each pair once
            pair = (pair[0], pair[1], pair[2][keep], pair[3][keep])
        for at in range(0, len(pair[2]), 1 << 16):
            stack.append((pair[0], pair[1], pair[2][at : at + (1 << 16)], pair[3][at : at + (1 << 16)]))
    both = a.values if right is None else np.concatenate([a.values, b.values])
    return [(int(both[x]), int(both[y])) for x, y in forest.links if both[x] != both[y]]


def _link_buckets(masks: np.ndarray | None, distance: int):
    """A function over sorted batches that yields the links of each bucket.

    The batches hold the bucket's columns, the side (0 or 1) and the fingerprint.
    With ``masks`` the bucket is the projection and the fingerprint's masked bits.
    """

    def links(values: np.ndarray, side: np.ndarray) -> list[tuple[int, int]]:
        if side.min() != side.max():
            return spanning_links(values[side == 0], values[side == 1], distance)
        if len(values) <= 24:
            return [(x, y) for x, y in combinations(values.tolist(), 2) if (x ^ y).bit_count() <= distance]
        return spanning_links(values, None, distance)

    def of_runs(keys: np.ndarray, side: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        change = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1), True])
        length = np.diff(change)
        twos = change[:-1][length == 2]  # most buckets of more than one
        twos = twos[np.bitwise_count(values[twos] ^ values[twos + 1]) <= distance]
        found = [np.stack([values[twos], values[twos + 1]], axis=1)]
        for at in np.flatnonzero(length > 2):
            s, e = change[at], change[at + 1]
            if pairs := links(values[s:e], side[s:e]):
                found.append(np.array(pairs, np.uint64))
        both = np.concatenate(found).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last bucket so far, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy().astype(np.int64) for c in batch.columns]
            values = columns[-1].view(np.uint64)
            if masks is not None:
                columns[1:1] = [(values & masks[columns[0]]).view(np.int64)]
            now = (np.stack(columns[:-2], axis=1), columns[-2], values)
            if held is not None:
                now = tuple(np.concatenate(x) for x in zip(held, now, strict=True))
            keys = now[0]
            other = np.flatnonzero((keys != keys[-1]).any(axis=1))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield of_runs(*(x[:cut] for x in now))
            held = tuple(x[cut:] for x in now)
        if held is not None:
            yield of_runs(*held)

    return run


def near_links(prints: DataFrame, distance: int = DISTANCE, large: int = LARGE) -> DataFrame:
    """``a, b``: links that connect all fingerprints (distinct, column ``fp``) within ``distance``.

    Each fingerprint is shuffled once for each projection. Large buckets are known
    from a draw of one fingerprint in ``DRAW``; a bucket that the draw misjudges is
    searched the other way, with the same links.
    """
    masks = block_masks(distance)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = ["projection", "bucket"]

    def project(df: DataFrame) -> DataFrame:
        buckets = F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in signed))
        return df.select(F.posexplode(buckets).alias(*keys), "fp")

    drawn = prints.where(F.pmod(F.xxhash64("fp"), F.lit(DRAW)) == 0) if large >= 16 * DRAW else prints
    share = DRAW if large >= 16 * DRAW else 1
    hot = project(drawn).groupBy(*keys).agg((F.count("*") * share).alias("n")).where(F.col("n") > large)
    hot = shared_table(hot)
    some_hot = not hot.isEmpty()
    small = prints.select(F.explode(F.sequence(F.lit(0), F.lit(len(masks) - 1))).alias("projection"), "fp")
    # The bucket follows from the two columns, so it is not sent.
    bucket = F.col("fp").bitwiseAND(F.element_at(F.array(*map(F.lit, signed)), F.col("projection") + 1))
    if some_hot:
        small = small.withColumn("bucket", bucket).join(hot, keys, "left_anti").drop("bucket")
    small = (
        small.repartition("projection", bucket)
        .sortWithinPartitions("projection", bucket)
        .select("projection", F.lit(0).alias("side"), "fp")
        .mapInArrow(_link_buckets(np.array(masks, np.uint64), distance), "a long, b long")
    )
    if not some_hot:
        return small.distinct()

    # Large buckets: runs along the Gray order, and the pairs of runs that may hold a link.
    ranked = project(prints).join(hot, keys).withColumn("rank", gray_rank_column(F.col("fp")))
    ranked = shared_table(ranked)
    n_max = ranked.agg(F.max("n")).first()[0]
    steps = [i / 32 for i in range(1, 32)]
    # Buckets are cut again and again by 32 until their runs are small enough.
    runs, cut = ranked.withColumn("run", F.lit(0).cast("bigint")), n_max
    while cut > large:
        bounds = runs.groupBy(*keys, "run").agg(F.percentile_approx("rank", steps).alias("bounds"))
        place = F.size(F.filter("bounds", lambda b: b < F.col("rank")))
        runs = shared_table(
            runs.join(bounds, [*keys, "run"]).withColumn("run", F.col("run") * 32 + place).drop("bounds")
        )
        cut //= 16
    nodes = runs.groupBy(*keys, "run").agg(
        F.expr("bit_and(fp)").alias("every"), F.expr("bit_or(fp)").alias("some"), F.count("*").alias("members")
    )
    nodes = shared_table(nodes)
    other = nodes.select(*keys, *(F.col(c).alias(f"{c}_b") for c in ("run", "every", "some")))
    fixed = F.col("every").bitwiseAND(F.bitwise_not("some_b")).bitwiseOR(
        F.col("every_b").bitwiseAND(F.bitwise_not("some"))
    )
    pairs = nodes.join(other, keys).where((F.col("run") <= F.col("run_b")) & (F.bit_count(fixed) <= distance))
    sides = pairs.select(
        *keys,
        F.col("run").alias("left"),
        F.col("run_b").alias("right"),
        F.explode(
            F.when(F.col("run") == F.col("run_b"), F.array(F.struct(F.col("run"), F.lit(0).alias("side"))))
            .otherwise(F.array(F.struct(F.col("run"), F.lit(0).alias("side")), F.struct(F.col("run_b").alias("run"), F.lit(1).alias("side"))))
        ).alias("x"),
    ).select(*keys, "left", "right", "x.run", "x.side")
    members = runs.select(*keys, "run", "fp").join(sides, [*keys, "run"])
    pairs_of_runs = [*keys, "left", "right"]
    crossing = (
        members.select(*pairs_of_runs, "side", "fp")
        .repartition(*pairs_of_runs)
        .sortWithinPartitions(*pairs_of_runs)
        .mapInArrow(_link_buckets(None, distance), "a long, b long")
    )
    return small.union(crossing).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", distance: int = DISTANCE, large: int = LARGE
) -> DataFrame:
    """``id_col, fingerprint`` (bigint), ``component``: the smallest id that links can reach.

    One row for each row of ``docs``. Documents without words have fingerprint
    zero and are linked like any other. A NULL id has a fingerprint and links
    others, but is no one's smallest id (NULL where a component has no other).
    """
    marked = shared_table(fingerprints(docs.select(id_col, text), text, "fp"))
    # Copies meet before anything else; one row of each fingerprint goes on.
    least = marked.groupBy("fp").agg(F.min(id_col).alias("least"))
    classes = components(near_links(least.select("fp"), distance, large))
    named = least.join(classes, least["fp"] == classes["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")
    )
    # Kept, so that the join is between two plain shuffles, which Spark splits at a large component.
    named = shared_table(named)
    smallest = shared_table(named.groupBy("root").agg(F.min("least").alias("component")))
    by_print = named.join(smallest, "root").select("fp", "component")
    return marked.join(by_print, "fp").select(id_col, F.col("fp").alias("fingerprint"), "component")
