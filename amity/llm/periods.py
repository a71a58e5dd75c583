"""Runs of words that repeat with a period, found online, and texts with each run told once.

A run is a stretch of consecutive words of smallest period ``q``, at least ``repeats * q`` and
``min_words`` long, that no neighbouring word extends. Words are read one by one. A lag is active
while each word equals the word that many places before; a word that does so again adds one to the
lag's match length, and when it does not, the lag's diagonal ends there and the run, if long enough,
is written at once. Only active lags are kept, not a table of words by words.

Which lags become active decides the cost: each word has as many earlier occurrences as its text
has copies of it, and a text of one word over and over would make every lag active. So lags are
taken by octave, ``L <= q < 2L``. A run of such a lag matches over ``(repeats - 1) * L`` words and
more, hence in the octave the occurrences asked for are those of the last ``g = (repeats - 1) * L``
words together, and only the nearest earlier one counts. No run is lost by that. Where the last
``g`` words lie in a run of smallest period ``q`` and occurred at a smaller lag ``p`` too, the
``g + p >= q + p`` words from there have both periods, so their greatest common divisor is a period
of them and of the run, against ``q`` being the smallest. For the same reason a lag that the nearest
occurrence gives throughout is the smallest period: multiples need no test. ``repeats`` of 3 and
more gives ``g >= 2L > q``.

Most words never get there: within a run every word occurred at most ``q`` places before, so an
octave only looks at stretches of ``g`` and more words that each have a copy less than ``2L``
before. Elsewhere one dictionary of last places is all that is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN = "start bigint, length bigint, period bigint"
#: Texts, in bytes, that a task holds as words at a time; a longer one is held alone.
HELD_BYTES = 4 << 20


def _nearest(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, equal for equal words, and how far before it the word stood (0: never)."""
    known: dict[bytes, int] = {}
    codes = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    order = np.argsort(codes, kind="stable")
    lag = np.zeros(len(words), np.int64)
    same = codes[order[1:]] == codes[order[:-1]]
    lag[order[1:][same]] = (order[1:] - order[:-1])[same]
    return codes, lag


def _stretches(inside: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """Where ``inside`` holds for ``least`` and more places on end."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    for start, end in zip(edges[::2], edges[1::2], strict=True):
        if end - start >= least:
            yield int(start), int(end)


def _grams(codes: np.ndarray, n: int) -> list[int]:
    """A number for the ``n`` words that end at each place from ``n - 1`` on, equal for equal words.

    Numbers of 1, 2, 4, … words are joined in pairs, so nothing is hashed and nothing can collide."""

    def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.unique(left * (right.max() + 1) + right, return_inverse=True)[1].astype(np.int64)

    span, of_span = 1, np.unique(codes, return_inverse=True)[1].astype(np.int64)
    width, out = 0, None
    while True:
        if n & span:
            out = of_span if out is None else joined(of_span[: len(of_span) - width], out[span:])
            width += span
        if 2 * span > n:
            return out.tolist()
        of_span = joined(of_span[:-span], of_span[span:])
        span *= 2


def _online(codes: np.ndarray, first: int, low: int, repeats: int, min_words: int) -> Iterator[tuple[int, int, int]]:
    """Runs of the octave ``low <= q < 2 * low`` within ``codes``, whose first word is word ``first``."""
    g = (repeats - 1) * low
    words, grams = codes.tolist(), _grams(codes, g)
    last: dict[int, int] = {}
    active: dict[int, int] = {}
    for i in range(g - 1, len(words) + 1):
        ended = i == len(words)
        if active:
            going: dict[int, int] = {}
            for q, matched in active.items():
                if not ended and words[i] == words[i - q]:
                    going[q] = matched + 1
                elif matched + q >= max(min_words, repeats * q):
                    yield first + i - matched - q, matched + q, q
            active = going
        if ended:
            return
        gram = grams[i - g + 1]
        lag = i - last.get(gram, -1 - 2 * low)
        last[gram] = i
        if low <= lag < 2 * low and lag not in active:
            active[lag] = g


def word_runs(words: list[bytes], repeats: int = 4, min_words: int = 6) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run, by start, then period."""
    codes, lag = _nearest(words)
    found: list[tuple[int, int, int]] = []
    low = 1
    while repeats * low <= len(words):
        g = (repeats - 1) * low
        inside = (lag > 0) & (lag < 2 * low)
        for start, end in _stretches(inside, g):
            first = max(0, start - 2 * low)  # the words that the stretch repeats
            found += _online(codes[first:end], first, low, repeats, min_words)
        low *= 2
    return sorted(set(found))


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    dropped = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    keep = np.flatnonzero(np.cumsum(dropped[:-1]) == 0)
    return b" ".join([words[i] for i in keep.tolist()])


def _longest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length by period, compared as whole numbers; the first of equal ones."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def periodic_runs(
    docs: DataFrame, text_col: str = "text", repeats: int = 4, min_words: int = 6
) -> DataFrame:
    """All columns of ``docs``, with ``runs`` (by start, then period), the run ``longest`` and
    ``collapsed``.

    ``longest`` has the greatest length by period (of equal ones the first by start, then period;
    NULL without runs). ``collapsed`` is the text's words joined by one space, where of each run
    only the first period stays. Words are what stands between blanks (space and \\t \\n \\v \\f \\r),
    compared by their bytes; numbers count from 0. ``repeats`` is 3 or more.

    NULL, empty and blank texts have no words, no run and an empty ``collapsed``. Each row stands
    for itself, repeated rows and ids too; a run never crosses rows. Columns of ``docs`` of the
    names above are replaced. A text is worked on whole, in time ``n log n`` whatever it repeats
    and with memory in proportion to it; there is no shuffle, so hot keys do not matter, and a
    lost task only reads its rows again.
    """
    if repeats < 3:
        raise ValueError(f"repeats must be 3 or more, not {repeats}")
    docs = docs.drop("runs", "longest", "collapsed")
    place = docs.columns.index(text_col) if text_col in docs.columns else None
    if place is None or docs.schema[text_col].dataType.typeName() != "string":
        raise ValueError(f"no text column {text_col!r}")
    run_type = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        start = held = 0
        sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_pylist()
        for i, n in enumerate(sizes):
            if i > start and held + n > HELD_BYTES:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                runs, longest, collapsed = [], [], []
                for text in part.column(place).cast(pa.binary()).to_pylist():
                    words = text.split() if text else []
                    found = word_runs(words, repeats, min_words)
                    runs.append(found)
                    longest.append(_longest(found))
                    collapsed.append(_collapsed(words, found))
                named = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in row] for row in runs]
                best = [r and dict(zip(("start", "length", "period"), r, strict=True)) for r in longest]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array(named, pa.list_(run_type)),
                        pa.array(best, run_type),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    names=[*part.schema.names, "runs", "longest", "collapsed"],
                )

    schema = docs.select(
        "*",
        F.lit(None).cast(f"array<struct<{RUN.replace(' bigint', ':bigint')}>>").alias("runs"),
        F.lit(None).cast(f"struct<{RUN.replace(' bigint', ':bigint')}>").alias("longest"),
        F.lit(None).cast("string").alias("collapsed"),
    ).schema
    return docs.mapInArrow(of_batch, schema)
