"""Exact repeats by induced suffix sorting.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier.
Strings are dealt to shards by content: the least hash of the ``GRAM``-byte grams
in a string is the same wherever the string stands. Neighbouring strings mostly
share it, so one run of them is one segment. A first pass counts the hashes; only
segments whose hash occurs again are shuffled. Equal segments are one before the
shuffle and after it: all but the first are repeats as a whole.

A shard is what is left of some hashes, a bounded number of different segments
each. Its suffixes are put in order by induced sorting: suffixes that are smaller
than both neighbours are sorted by recursion on their names, and all others follow
by two scans over queues, one for each first byte, whose entries come out in order.
Queues of large shards lie on disk. Neighbours in the order that share ``LENGTH``
bytes are one string, of which the first occurrence stays.

Hashes in very many segments (a common line in ever different surroundings)
would make large shards. Their strings are told apart one by one, by a 128-bit
digest of their own, and merged by it before the shuffle.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amity.llm.tables import pack, shared_table, unpack

LENGTH = 100
GRAM = 32
HOT = 2048  # segments of one hash
SIEVE_BITS = 27
SHARD_BYTES = 1 << 20
QUEUED = 1 << 24  # entries that a queue keeps in memory


class Queue:
    """Numbers in the order in which they were added; beyond ``QUEUED`` on disk."""

    def __init__(self, limit: int = QUEUED):
        self.limit, self.parts, self.held, self.file = limit, [], 0, None

    def add(self, values: np.ndarray) -> None:
        self.parts.append(values)
        self.held += len(values)
        if self.held > self.limit:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(0, 2)
            for part in self.parts:
                part.astype(np.int64).tofile(self.file)
            self.parts, self.held = [], 0

    def take(self) -> np.ndarray:
        """All that was added since the last time."""
        parts, self.parts, self.held = self.parts, [], 0
        if self.file is not None:
            self.file.seek(0)
            parts.insert(0, np.fromfile(self.file, np.int64))
            self.file.close()
            self.file = None
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _kinds(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last (the end mark) is."""
    up = np.ones(len(t), bool)
    if len(t) > 1:
        step = np.sign(t[1:] - t[:-1])
        at = np.where(step != 0, np.arange(len(step)), len(step))
        following = np.minimum.accumulate(at[::-1])[::-1]  # the next place with a difference
        up[:-1] = np.append(step, 1)[following] > 0
    return up


def _deal(queues: list[Queue], places: np.ndarray, symbols: np.ndarray) -> None:
    order = np.argsort(symbols.astype(np.uint16), kind="stable")  # a radix sort
    symbols, places = symbols[order], places[order]
    cuts = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
    for s, e in zip(cuts, [*cuts[1:], len(symbols)], strict=True):
        queues[symbols[s]].add(places[s:e])


def _induce(t: np.ndarray, up: np.ndarray, minima: np.ndarray, symbols: int, limit: int) -> np.ndarray:
    """All suffixes in order, from the order of the local minima (the end mark first)."""
    falling = [Queue(limit) for _ in range(symbols)]
    rising = [Queue(limit) for _ in range(symbols)]
    first = t[minima]
    starts = np.searchsorted(first, np.arange(symbols + 1))
    done: list[list[np.ndarray]] = [[] for _ in range(symbols)]

    def before(places: np.ndarray, wanted: bool, queues: list[Queue]) -> None:
        places = places[places > 0] - 1
        places = places[up[places] == wanted]
        if len(places):
            _deal(queues, places, t[places])

    for c in range(symbols):
        while len(now := falling[c].take()):
            done[c].append(now)
            before(now, False, falling)
        before(minima[starts[c] : starts[c + 1]], False, falling)
    out: list[np.ndarray] = []  # backwards
    for c in range(symbols - 1, -1, -1):
        while len(now := rising[c].take()):
            out.append(now)
            before(now, True, rising)
        if done[c]:
            now = np.concatenate(done[c])[::-1]
            out.append(now)
            before(now, True, rising)
    order = np.concatenate(out)[::-1] if out else np.zeros(0, np.int64)
    return np.concatenate([[len(t) - 1], order])  # nothing before the end mark leads to it


def _induce_wide(t: list[int], up: list[bool], minima: list[int], symbols: int) -> list[int]:
    """As ``_induce``, place by place: for many symbols with few suffixes each."""
    sizes = [0] * symbols
    for c in t:
        sizes[c] += 1
    heads, total = [], 0
    for n in sizes:
        heads.append(total)
        total += n
    tails = [h + n for h, n in zip(heads, sizes, strict=True)]
    order, ends = [-1] * len(t), tails[:]
    for i in reversed(minima):
        ends[t[i]] -= 1
        order[ends[t[i]]] = i
    for at in range(len(t)):
        j = order[at] - 1
        if j >= 0 and not up[j]:
            order[heads[t[j]]] = j
            heads[t[j]] += 1
    for at in range(len(t) - 1, -1, -1):
        j = order[at] - 1
        if j >= 0 and up[j]:
            tails[t[j]] -= 1
            order[tails[t[j]]] = j
    return order


def suffix_order(t: np.ndarray, symbols: int, limit: int = QUEUED) -> np.ndarray:
    """Places of all suffixes of ``t`` in order; ``t`` ends with its only 0."""
    n = len(t)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    up = _kinds(t)
    minima = np.flatnonzero(up[1:] & ~up[:-1]) + 1
    wide = symbols > 1024

    def induce(sorted_minima: np.ndarray) -> np.ndarray:
        if wide:
            return np.array(_induce_wide(t.tolist(), up.tolist(), sorted_minima.tolist(), symbols))
        return _induce(t, up, sorted_minima, symbols, limit)

    by_symbol = minima[np.argsort(t[minima], kind="stable")]
    pieces = induce(by_symbol)
    # The minima now are in the order of the pieces up to the next minimum; equal ones get one name.
    is_minimum = np.zeros(n, bool)
    is_minimum[minima] = True
    pieces = pieces[is_minimum[pieces]]
    number = np.zeros(n, np.int64)
    number[minima] = np.arange(len(minima))
    stops = np.append(minima[1:], n - 1)
    length = stops[number[pieces]] - pieces + 1
    same = np.append(False, length[1:] == length[:-1])
    same[:2] = False  # the end mark is alone
    left = np.flatnonzero(same)
    offset = 0
    while len(left):  # compare neighbours symbol by symbol, as long as they agree
        a, b = pieces[left], pieces[left - 1]
        more = offset < length[left]
        equal = ~more | (t[np.minimum(a + offset, n - 1)] == t[np.minimum(b + offset, n - 1)])
        same[left[~equal]] = False
        left = left[equal & more]
        offset += 1
    names = np.cumsum(~same) - 1
    if names[-1] + 1 == len(minima):
        return induce(pieces)
    reduced = np.zeros(len(minima), np.int64)
    reduced[number[pieces]] = names
    return induce(minima[suffix_order(reduced, int(names[-1]) + 1, limit)])


def equal_strings(segments: list[bytes], length: int = LENGTH, limit: int = QUEUED) -> list[list[tuple[int, int]]]:
    """The strings of ``length`` bytes that occur more than once in the segments, each as its
    (segment, offset) pairs."""
    sizes = np.array([len(s) for s in segments])
    t = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8).astype(np.int64) + 2
    begins = np.cumsum(sizes + 1) - sizes - 1
    t[begins + sizes] = 1  # between segments
    t = np.append(t, 0)
    order = suffix_order(t, 258, limit)
    of = np.repeat(np.arange(len(segments)), sizes + 1)
    offset = np.arange(len(of)) - begins[of]
    whole = np.append(offset + length <= sizes[of], False)
    order = order[whole[order]]
    if len(order) < 2:
        return []
    windows = np.lib.stride_tricks.sliding_window_view(t.astype(np.int16), length)
    same = np.zeros(len(order), bool)
    for at in range(1, len(order), 4096):
        some = order[at - 1 : at + 4096]
        same[at : at + 4096] = (windows[some[1:]] == windows[some[:-1]]).all(axis=1)
    heads = np.flatnonzero(~same)
    stops = np.append(heads[1:], len(order))
    return [
        [(int(of[p]), int(offset[p])) for p in order[s:e]] for s, e in zip(heads, stops, strict=True) if e - s > 1
    ]


def _slide(h: np.ndarray, span: int, pick) -> np.ndarray:
    """The least or greatest (``pick``) of every ``span`` neighbours."""
    have = 1
    while 2 * have <= span:
        h = pick(h[:-have], h[have:])
        have *= 2
    return pick(h[: have - span], h[span - have :]) if have < span else h


def gram_hashes(data: bytes, gram: int = GRAM) -> np.ndarray:
    h = (np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    width, factor = 1, 0xD6E8FEB86659FD93
    while width < gram:
        h = h[:-width] * np.uint64(factor) + h[width:]
        factor = factor * factor % (1 << 64) | 1
        width *= 2
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(31))


NOTHING = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))


def runs(data: bytes, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings with the same least gram hash: first start, last start, hash."""
    if len(data) < LENGTH:
        return NOTHING
    least = _slide(gram_hashes(data) if hashes is None else hashes, LENGTH - GRAM + 1, np.minimum)
    cuts = np.flatnonzero(least[1:] != least[:-1]) + 1
    starts = np.append(0, cuts)
    return starts, np.append(cuts, len(least)) - 1, least[starts]


def gram_place(hashes: np.ndarray, start: int, last: int, key: np.uint64) -> int:
    """Where the run's least gram stands in its segment; -1 if it stands there more than once."""
    places = np.flatnonzero(hashes[start : last + LENGTH - GRAM + 1] == key)
    return int(places[0]) if len(places) == 1 else -1


def may_repeat(group: dict[bytes, tuple]) -> list[tuple[bytes, tuple]]:
    """The segments of one hash that may share a string with another of them.

    A string has ``LENGTH - GRAM`` bytes around its least gram, so half of that at
    least on one side. A segment whose half on either side no other has shares none.
    """
    if any(gram < 0 for *_, gram in group.values()):
        return list(group.items())
    half = (LENGTH - GRAM) // 2
    sides: dict[tuple[bool, bytes], int] = {}
    own = []
    for data, (*_, gram) in group.items():
        found = []
        if gram >= half:
            found.append((False, data[gram - half : gram]))
        if len(data) - gram - GRAM >= half:
            found.append((True, data[gram + GRAM : gram + GRAM + half]))
        own.append(found)
        for side in found:
            sides[side] = sides.get(side, 0) + 1
    return [x for x, found in zip(group.items(), own, strict=True) if any(sides[s] > 1 for s in found)]


def run_hashes(data: bytes) -> np.ndarray:
    """The hash of each run, and once more for each that is found twice inside one run, as
    in a text that repeats itself within a string's length. A run goes on where its gram
    stands again ``span`` places later: the string after the one that starts with it holds both."""
    if len(data) < LENGTH:
        return NOTHING[2]
    h, span = gram_hashes(data), LENGTH - GRAM + 1
    least = _slide(h, span, np.minimum)
    # A gram is the least of some string if it is the greatest of the least ones around it.
    around = _slide(np.pad(least, span - 1), span, np.maximum)
    places = np.flatnonzero(h == around)
    found = h[places]
    twice = found[1:][(found[1:] == found[:-1]) & (np.diff(places) <= span)]
    return np.concatenate([least[:1], least[1:][least[1:] != least[:-1]], twice])


def _hash_counts(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [run_hashes((v.as_py() or "").encode()) for v in batch.column(0)]
            keys, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], ["key", "n"])

    return rows.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _sieves(counts: DataFrame, hot: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit sets of 2**SIEVE_BITS by hash: of hashes that occur again, and of hot ones. Their size
    does not depend on the data; a hash that shares a bit is only looked at in vain."""
    slot = f"(key & {(1 << SIEVE_BITS) - 1})"
    bit = f"shiftleft(1L, cast({slot} & 63 AS int))"
    words = counts.where("n > 1").groupBy(F.expr(f"cast(shiftright({slot}, 6) AS int)").alias("word")).agg(
        F.expr(f"bit_or({bit})").alias("again"), F.expr(f"bit_or(if(n > {hot}, {bit}, 0L))").alias("hot")
    ).toArrow()
    out = []
    for name in ("again", "hot"):
        bits = np.zeros((1 << SIEVE_BITS) // 64, np.int64)
        bits[words["word"].to_numpy()] = words[name].to_numpy()
        out.append(bits.view(np.uint64))
    return out[0], out[1]


def _in(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys & np.uint64((1 << SIEVE_BITS) - 1)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


FOUND = pa.schema([
    ("part", pa.int64()), ("kind", pa.int32()), ("key", pa.int64()), ("low", pa.int64()), ("place", pa.int64()),
    ("row", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("gram", pa.int32()), ("data", pa.binary()),
])
FOUND_SQL = "part long, kind int, key long, low long, place long, row long, start long, stop long, gram int, data binary"
REPEAT, SEGMENT, STRING = 0, 1, 2


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _candidates(rows: DataFrame, again: np.ndarray, hot: np.ndarray) -> DataFrame:
    """Segments and single strings that may occur again, the first of equal ones in each batch, and
    the repeats that a batch shows by itself."""
    shared = rows.sparkSession.sparkContext.broadcast((again, hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again, hot = shared.value
        for batch in batches:
            first: dict = {}  # the content: (kind, key, low), occurrence
            out = []

            def meet(content, key: tuple, here: tuple, first=first, out=out) -> None:
                there = first.get(content)
                if there is None or here < there[1]:
                    first[content] = (key, here)
                    here = there and there[1]
                elif here == there[1]:
                    return
                if here:
                    _, row, start, stop, _ = here
                    out.append((row, REPEAT, 0, 0, 0, row, start, stop, 0, None))

            for row, place, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = (value or "").encode()
                hashes = gram_hashes(data) if len(data) >= LENGTH else None
                starts, lasts, keys = runs(data, hashes)
                found = _in(again, keys)
                starts, lasts, keys = starts[found], lasts[found], keys[found]
                columns = starts.tolist(), lasts.tolist(), keys, keys.view(np.int64).tolist(), _in(hot, keys).tolist()
                for s, e, least, key, is_hot in zip(*columns, strict=True):
                    if is_hot:
                        for at in range(s, e + 1):
                            digest = xxhash.xxh3_128_intdigest(data[at : at + LENGTH])
                            high, low = _signed(digest >> 64), _signed(digest & ((1 << 64) - 1))
                            meet(digest, (STRING, high, low), (place, row, at, at + LENGTH, 0))
                    else:
                        here = (place, row, s, e + LENGTH, gram_place(hashes, s, e, least))
                        meet(data[s : e + LENGTH], (SEGMENT, key, 0), here)
            for content, ((kind, key, low), here) in first.items():
                out.append((key, kind, key, low, *here, content if kind == SEGMENT else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), FOUND.types, strict=True)]
                if out else [pa.array([], t) for t in FOUND.types],
                schema=FOUND,
            )

    return rows.select("row", "place", "text").mapInArrow(run, FOUND_SQL)


def merged(spans: np.ndarray) -> list[np.ndarray]:
    """Rows, starts and stops of (row, start, stop) spans, those of a row that touch made one."""
    row, start, stop = spans[np.lexsort((spans[:, 1], spans[:, 0]))].T
    if not len(row):
        return [row, start, stop]
    # Stops so far within a row: rows are set apart by more than any text is long.
    apart = np.cumsum(np.append(False, row[1:] != row[:-1])) * (int(stop.max()) + 2)
    reach = np.maximum.accumulate(stop + apart)
    heads = np.flatnonzero(np.append(True, start[1:] + apart[1:] > reach[:-1]))
    ends = np.append(heads[1:], len(row)) - 1
    return [row[heads], start[heads], reach[ends] - apart[ends]]


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats as ``row, start, stop``, from candidates sorted by kind, key and low."""
    out: list[tuple[int, int, int]] = []
    group: dict[bytes, tuple] = {}  # the different segments of one hash
    shard: list[tuple[bytes, tuple]] = []
    size, last, best = 0, None, None

    def sort_shard() -> None:
        for places in equal_strings([data for data, _ in shard]):
            seen = sorted((shard[i][1][0], shard[i][1][1], shard[i][1][2] + at) for i, at in places)
            out.extend((row, start, start + LENGTH) for place, row, start in seen if (place, row, start) != seen[0])
        shard.clear()

    def close_group() -> None:
        nonlocal size
        kept = may_repeat(group)
        shard.extend(kept)
        size += sum(len(data) for data, _ in kept)
        group.clear()
        if size >= SHARD_BYTES:
            sort_shard()
            size = 0

    def emit() -> pa.RecordBatch:
        columns = merged(np.array(out, np.int64).reshape(-1, 3))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "start", "stop"])

    for batch in batches:
        for _, kind, key, low, place, row, start, stop, gram, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if kind == REPEAT:
                out.append((row, start, stop))
                continue
            here = (place, row, start, stop, gram)
            if (kind, key, low) != last:
                close_group()
                last, best = (kind, key, low), None
            known = group.get(data) if kind == SEGMENT else best
            if known is None or here < known:
                if known is not None:
                    out.append(known[1:4])
                if kind == SEGMENT:
                    group[data] = here
                else:
                    best = here
            elif here != known:
                out.append((row, start, stop))
        yield emit()
    close_group()
    if shard:
        sort_shard()
    yield emit()


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", hot: int = HOT
) -> DataFrame:
    """``docs`` with the text's bytes in place of the text: ``kept`` (binary, the bytes that stay),
    ``n_bytes``, ``n_removed`` and ``n_spans`` (maximal removed runs).

    Earlier is a smaller id, NULL last, then the text's hash, then the start; rows equal
    in id and text are one document and get the same result. NULL counts as the
    empty text; texts under ``LENGTH`` bytes lose nothing. What is kept may cut a
    character in two, so it is binary. Other columns stay, whatever their names, but
    for the four named here, which are replaced.
    """
    made = ["kept", "n_bytes", "n_removed", "n_spans"]
    source = docs.drop(*made)
    if {"spans", "row_of_text"} & set(source.columns):  # this function's own names
        found = remove_repeats(pack(source, id_col, text), id_col, text, hot)
        return unpack(found, [c for c in source.columns if c != text], *made)
    whole = F.coalesce(F.col(text), F.lit(""))
    row = F.xxhash64(F.col(id_col).isNull(), F.col(id_col), whole)
    rows = source.select(
        row.alias("row"), F.coalesce(F.col(id_col).cast("bigint"), F.lit((1 << 63) - 1)).alias("place"), whole.alias("text")
    )
    again, often = _sieves(_hash_counts(rows), hot)
    repeats = (
        _candidates(rows, again, often)
        .repartition("part")
        .sortWithinPartitions("kind", "key", "low")
        .mapInArrow(_resolve, "row long, start long, stop long")
    )
    # Overlapping ones are merged per document at once: a stretch starts where none before reaches.
    spans = repeats.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    joined = source.withColumn("row_of_text", row).join(
        shared_table(spans).withColumnRenamed("row", "row_of_text"), "row_of_text", "left"
    )
    others = [c for c in source.columns if c != text]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for value, spans in zip(batch.column(len(others)), batch.column(len(others) + 1), strict=True):
                data, at, kept, n_spans = (value.as_py() or "").encode(), 0, [], 0
                reached = -1
                for span in spans.as_py() or ():
                    if span["start"] > reached:
                        n_spans += 1
                        kept.append(data[at : span["start"]])
                    reached = max(reached, span["stop"])
                    at = reached
                kept.append(data[at:])
                left = b"".join(kept)
                for column, x in zip(columns, (left, len(data), len(data) - len(left), n_spans), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(others)], pa.array(columns[0], pa.binary()), *(pa.array(c, pa.int64()) for c in columns[1:])],
                [*others, "kept", "n_bytes", "n_removed", "n_spans"],
            )

    schema = T.StructType([
        *(source.schema[c] for c in others), T.StructField("kept", T.BinaryType()),
        *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
    ])
    return joined.select(*others, text, "spans").mapInArrow(cut, schema)


