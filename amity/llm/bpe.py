"""Byte-level BPE by tree reduction.

A piece (one match of the split pattern) is cut in halves down to short leaves,
which are merged directly. Two encoded neighbours are joined by re-encoding a
window around the border. The window grows on the side whose border is not yet
settled. Both borders are settled when the last token before the window and the
first in it stay apart if encoded together, and likewise at the other end: a
sequence of tokens is the encoding of its bytes exactly if each two neighbours
are the encoding of theirs, and inside the window and outside of it they are.

Decoding joins the tokens' bytes in blocks and then the blocks.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

LEAF_BYTES = 6
CACHED_PIECES = 150_000  # about 40 MB of Python objects a worker when full; kept between tasks
CACHED_MERGES = 40_000
CACHED_BYTES = 64  # longer pieces and windows are not cached, so that the caches are bounded in bytes
DECODE_BLOCK = 1024


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """The ranks of a ``.tiktoken`` file's content."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


class TreeEncoder(dict):
    """Ids of a piece (text) by looking it up; what is missing is encoded.

    Holds at most ``CACHED_PIECES`` pieces of ``CACHED_BYTES`` or fewer, then starts anew.
    """

    def __init__(self, ranks: dict[bytes, int], leaf_bytes: int = LEAF_BYTES):
        super().__init__()
        self.ranks = ranks
        self.leaf_bytes = leaf_bytes
        self.apart = lru_cache(maxsize=CACHED_MERGES)(self._apart)
        self.short = lru_cache(maxsize=CACHED_MERGES)(self.merge)

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= CACHED_PIECES:
            self.clear()
        whole = piece.encode()
        ids = tuple(map(self.ranks.__getitem__, self.encode(whole)))
        if len(whole) <= CACHED_BYTES:
            self[piece] = ids
        return ids

    def encode(self, piece: bytes) -> list[bytes]:
        if piece in self.ranks:
            return [piece]
        if len(piece) <= self.leaf_bytes:
            return self.short(piece)
        middle = len(piece) // 2
        return self.join(self.encode(piece[:middle]), self.encode(piece[middle:]))

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """The encoding of two encoded neighbours' bytes."""
        if self.apart(left[-1], right[0]):  # then the border is settled as it is
            return left + right
        before, after = len(left) - 1, 1
        while True:
            border = b"".join(left[before:]) + b"".join(right[:after])
            window = self.short(border) if len(border) <= CACHED_BYTES else self.merge(border)
            left_open = before > 0 and not self.apart(left[before - 1], window[0])
            right_open = after < len(right) and not self.apart(window[-1], right[after])
            if not left_open and not right_open:
                return left[:before] + window + right[after:]
            if left_open:
                before = max(0, 2 * before - len(left))
            if right_open:
                after = min(len(right), 2 * after)

    def _apart(self, a: bytes, b: bytes) -> bool:
        return self.merge(a + b) == [a, b]

    def merge(self, piece: bytes) -> list[bytes]:
        """Merge the pair of lowest rank, the leftmost of equals, until none is left."""
        if piece in self.ranks:
            return [piece]
        if len(piece) > CACHED_BYTES:
            return self._merge_long(piece)
        ranks = self.ranks
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [ranks.get(piece[i : i + 2], 1 << 60) for i in range(len(piece) - 1)]
        while pairs and (least := min(pairs)) < 1 << 60:
            i = pairs.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 60)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 60)
        return parts

    def _merge_long(self, piece: bytes) -> list[bytes]:
        """As ``merge``, with a queue of pairs: n log n."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # of the part that starts here; 0: it has been merged away
        previous = list(range(-1, n - 1))
        queue = [(ranks[piece[i : i + 2]], i, i + 2) for i in range(n - 1) if piece[i : i + 2] in ranks]
        heapq.heapify(queue)
        while queue:
            _, start, stop = heapq.heappop(queue)
            middle = end[start]
            if not middle or middle >= stop or end[middle] != stop:
                continue
            end[start], end[middle] = stop, 0
            if stop < n:
                previous[stop] = start
                if (rank := ranks.get(piece[start : end[stop]])) is not None:
                    heapq.heappush(queue, (rank, start, end[stop]))
            if (before := previous[start]) >= 0 and (rank := ranks.get(piece[before:stop])) is not None:
                heapq.heappush(queue, (rank, before, stop))
        parts, i = [], 0
        while i < n:
            parts.append(piece[i : end[i]])
            i = end[i]
        return parts


_loaded: dict[bytes, TreeEncoder] = {}


def _encoder(raw: bytes) -> TreeEncoder:
    """One encoder a worker and vocabulary."""
    key = blake2b(raw).digest()
    if key not in _loaded:
        _loaded[key] = TreeEncoder(read_ranks(raw))
    return _loaded[key]


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """``docs`` with the ids of each whole text in place of the text.

    Pieces are the matches of ``pattern``; strings of special tokens are
    ordinary text. NULL counts as the empty text, which has no ids. Rows keep
    their other columns; equal rows are encoded each. ``ranks_path`` is read by
    the driver; the vocabulary (under 1 MB, it does not grow with the data) is
    broadcast. No shuffle, and nothing is kept beyond one batch and the bounded
    table of pieces, so a lost task is simply run again.
    """
    spark = docs.sparkSession
    with open(ranks_path, "rb") as file:
        vocabulary = spark.sparkContext.broadcast(file.read())
    others = [c for c in docs.columns if c not in (text, ids)]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary.value)
        pieces = regex.compile(pattern)
        for batch in batches:
            lists, offsets, flat = [], [0], 0
            for value in batch.column(batch.schema.get_field_index(text)):
                found = list(chain.from_iterable(map(encoder.__getitem__, pieces.findall(value.as_py() or ""))))
                flat += len(found)
                offsets.append(flat)
                lists.append(pa.array(found, pa.int32()))
            values = pa.concat_arrays(lists) if lists else pa.array([], pa.int32())
            column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in others] + [column], [*others, ids]
            )

    schema = T.StructType([docs.schema[c] for c in others] + [T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return docs.select(*others, text).mapInArrow(encode, schema)


def decode_documents(
    encoded: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``encoded`` with the bytes of each list of ids added. NULL counts as no ids; an id that
    the vocabulary lacks is an error."""
    spark = encoded.sparkSession
    with open(ranks_path, "rb") as file:
        vocabulary = spark.sparkContext.broadcast(file.read())
    others = [c for c in encoded.columns if c != decoded]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in _encoder(vocabulary.value).ranks.items()}
        for batch in batches:
            out = []
            for value in batch.column(batch.schema.get_field_index(ids)):
                row = value.values.to_numpy(zero_copy_only=False).tolist() if value.is_valid else []
                blocks = [
                    b"".join(map(tokens.__getitem__, row[i : i + DECODE_BLOCK]))
                    for i in range(0, len(row), DECODE_BLOCK)
                ]
                out.append(b"".join(blocks))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in others] + [pa.array(out, pa.binary())],
                [*others, decoded],
            )

    schema = T.StructType([encoded.schema[c] for c in others] + [T.StructField(decoded, T.BinaryType())])
    return encoded.select(*others).mapInArrow(decode, schema)
