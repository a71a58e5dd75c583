import random
import re
import zlib
from fractions import Fraction
from hashlib import sha256

import pytest

from amity.llm.periods import periodic_runs, word_runs
from amity.llm.queries import QUERIES


def plain(words, repeats=4, min_words=6):
    """By the definition: all stretches of every period, of equal ones the smallest period."""
    n, found = len(words), {}
    for q in range(1, n // repeats + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            first = i
            while i < n and words[i] == words[i - q]:
                i += 1
            if i - first + q >= max(min_words, repeats * q):
                found.setdefault((first - q, i - first + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts():
    rng = random.Random(11)
    for _ in range(1500):
        yield [rng.choice("ab") for _ in range(rng.randrange(60))]
        yield [rng.choice("abcd") for _ in range(rng.randrange(40))]
    for _ in range(300):  # nested and neighbouring repetitions of every period
        out = []
        for _ in range(rng.randrange(1, 4)):
            unit = [rng.choice("abc") for _ in range(rng.randrange(1, 12))]
            if rng.random() < 0.5:
                unit = unit * rng.randrange(1, 6) + [rng.choice("abc")]
            out += (unit * rng.randrange(1, 9))[: rng.randrange(1, 200)]
            out += [rng.choice("abc") for _ in range(rng.randrange(3))]
        yield out
    thue = "a"
    for _ in range(9):
        thue += thue.translate(str.maketrans("ab", "ba"))
    yield list(thue)
    yield list((thue[:50] * 7)[:331])
    a, b = "a", "ab"
    while len(b) < 600:
        a, b = b, b + a
    yield list(b)
    yield list(b[:89] * 5)


def test_runs_by_definition():
    for words in texts():
        units = [w.encode() for w in words]
        assert word_runs(units) == plain(words), words


@pytest.mark.parametrize(("repeats", "least"), [(3, 1), (5, 6), (4, 30)])
def test_other_thresholds(repeats, least):
    for words in list(texts())[::7]:
        assert word_runs([w.encode() for w in words], repeats, least) == plain(words, repeats, least)


def test_one_word_very_often():
    """All lags of such a text match everywhere; only the first is ever active."""
    assert word_runs([b"a"] * 200_000) == [(0, 200_000, 1)]
    words = ([b"a"] * 9 + [b"b"]) * 8_000
    runs = word_runs(words)
    assert (0, 80_000, 10) in runs and len(runs) == 8_001


def test_rows(spark):
    rows = [
        (1, "x a b  a\tb\na b a b y", "k"),
        (1, "x a b  a\tb\na b a b y", "k"),
        (2, None, None),
        (3, "", "k"),
        (4, " \n ", "k"),
        (None, "é é é é é é é", "k"),
        (5, "a b c", "k"),
        (6, "w " * 70_000, "k"),
        (7, " ".join(f"{i % 20_000}" for i in range(90_000)), "k"),
    ]
    # Columns of the operator's own names and of other types are no obstacle.
    df = spark.createDataFrame(rows, "doc_id long, text string, extra string").withColumns(
        {"runs": "doc_id", "words": "doc_id", "lag": "text"}
    )
    out = periodic_runs(df)
    assert out.columns == ["doc_id", "text", "extra", "words", "lag", "runs", "longest", "collapsed"]
    got = [(r.doc_id, [tuple(x) for x in r.runs], r.longest and tuple(r.longest), r.collapsed) for r in out.collect()]
    by_id = {r[0]: r[1:] for r in got}
    assert len(got) == len(rows) and got[0] == got[1]
    assert by_id[1] == ([(1, 8, 2)], (1, 8, 2), "x a b y")
    assert by_id[2] == by_id[3] == by_id[4] == ([], None, "")
    # A no-break space is part of its word.
    assert by_id[None] == ([], None, "é é é é é é é")
    assert by_id[5] == ([], None, "a b c")
    assert by_id[6] == ([(0, 70_000, 1)], (0, 70_000, 1), "w")
    assert by_id[7][0] == [(0, 90_000, 20_000)]
    assert by_id[7][2] == " ".join(map(str, range(20_000)))
    assert periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="no text column"):
        periodic_runs(df, "doc_id")


def test_longest_is_exact():
    from amity.llm.periods import _longest

    assert _longest([(0, 13, 3), (20, 26, 6), (50, 13, 3)]) == (0, 13, 3)
    assert _longest([(0, 12, 3), (20, 24, 6)]) == (0, 12, 3)
    assert _longest([(0, 13, 3), (20, 27, 6)]) == (20, 27, 6)
    assert _longest([]) is None


def test_texts_against_plain(spark):
    rows = [(i, " ".join(words)) for i, words in enumerate(texts()) if i % 5 == 0]
    got = {r.doc_id: r for r in periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        runs = plain(text.split())
        assert [tuple(r) for r in got[i].runs] == runs
        assert got[i].collapsed == collapsed(text.split(), runs)


def contract(doc_id, text):
    """One row of the query, from its words on, in plain Python."""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + (h // 10) % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    told = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        sha256(told.encode()).hexdigest(), sha256(collapsed(words, runs).encode()).hexdigest(),
    )


def test_query(spark, tmp_path):
    rng = random.Random(5)
    rows = [(1, None), (2, ""), (3, " ")]
    rows += [(i, " ".join(rng.choice(["x", "y", "é", "long"]) for _ in range(rng.randrange(90)))) for i in range(4, 200)]
    rows += [(i, " ".join(str(rng.randrange(50)) for _ in range(rng.randrange(300)))) for i in range(200, 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for c, t in got.dtypes if not c.endswith("sha256")} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == [contract(*r) for r in rows]
