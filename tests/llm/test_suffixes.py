import random

import numpy as np
import pytest

from amity.llm.suffixes import LENGTH, Queue, equal_strings, merged, remove_repeats, runs, suffix_order


@pytest.mark.parametrize("letters", ["ab", "a", "abcdefgh", "".join(map(chr, range(200)))])
def test_suffix_order(letters):
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 10, 100, 700):
        for repeat in (1, 4):
            text = "".join(rng.choice(letters) for _ in range(n)) * repeat
            t = np.array([ord(c) + 1 for c in text] + [0], np.int64)
            want = sorted(range(len(t)), key=lambda i: t[i:].tolist())
            assert suffix_order(t, 258).tolist() == want
            assert suffix_order(t, 258, limit=3).tolist() == want  # queues on disk
            assert suffix_order(t, 5000).tolist() == want  # place by place


def test_queue_keeps_its_order():
    queue = Queue(limit=4)
    for i in range(0, 30, 3):
        queue.add(np.arange(i, i + 3))
    assert queue.take().tolist() == list(range(30))
    assert not len(queue.take())


def test_merged_spans():
    rng = random.Random(7)
    spans = [(rng.randint(-2, 2), a := rng.randrange(400), a + rng.randint(1, 30)) for _ in range(90)]
    covered = {(row, i) for row, a, b in spans for i in range(a, b)}
    got = list(zip(*(c.tolist() for c in merged(np.array(spans))), strict=True))
    assert {(row, i) for row, a, b in got for i in range(a, b)} == covered
    assert all((row, b) not in covered and (row, a - 1) not in covered for row, a, b in got)
    assert len(merged(np.zeros((0, 3), np.int64))[0]) == 0


def test_equal_strings():
    rng = random.Random(2)
    parts = [bytes(rng.choice(b"abc") for _ in range(60)) for _ in range(6)]
    segments = [b"".join(rng.choice(parts) for _ in range(rng.randint(2, 5))) for _ in range(25)] + [b"\0\x01\xff" * 50]
    where = {}
    for i, s in enumerate(segments):
        for at in range(len(s) - 99):
            where.setdefault(s[at : at + 100], []).append((i, at))
    want = sorted(sorted(x) for x in where.values() if len(x) > 1)
    assert sorted(sorted(x) for x in equal_strings(segments)) == want


def test_runs_follow_the_content():
    rng = random.Random(3)
    text = bytes(rng.choice(b"abcdefgh ") for _ in range(3000))
    key = {}
    for data in (text, b"xyz" * 40 + text, text[777:], b"q" * 500):
        for s, e, h in zip(*runs(data), strict=True):
            for at in range(s, e + 1):
                assert key.setdefault(data[at : at + LENGTH], h) == h
    assert not len(runs(b"a" * 99)[0]) and len(runs(b"a" * 100)[0]) == 1


def plain(rows):
    """Brute force over (id, text), ids different and not NULL: bytes that stay, and removed runs."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for at in range(len(data) - LENGTH + 1):
            s = data[at : at + LENGTH]
            if s in seen:
                gone[at : at + LENGTH] = True
            seen.add(s)
        n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        out[i] = (bytes(b for b, g in zip(data, gone) if not g), len(data), int(gone.sum()), n_spans)
    return out


def corpus(seed):
    rng = random.Random(seed)

    def prose(n):
        return "".join(rng.choice("abcdefghijé  ") for _ in range(n))

    passages = [prose(n) for n in (99, 100, 101, 130, 400, 1500)]
    line = prose(60)
    texts = []
    for i in range(150):
        text = prose(rng.choice([0, 10, 99, 300, 900]))
        for _ in range(rng.randint(0, 2)):
            text += rng.choice(passages) + prose(rng.choice([0, 1, 50]))
        texts.append(text + (line if i % 3 == 0 else "") + prose(70))
    texts += texts[:20] + [t[:200] + "!" + t[200:] for t in texts[20:40]] + ["ab" * 700, "ab" * 300, "z" * 1000, "z" * 99, "", None]
    texts += ["\0" * 120, "\0" * 100, "é" * 80, "é" * 49]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("hot", [2048, 3])
def test_documents(spark, hot):
    rows = corpus(4)
    docs = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, kept string, row int").repartition(9)
    got = {r.doc_id: (bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in remove_repeats(docs, hot=hot).collect()}
    assert got == plain(rows)


def test_odd_rows(spark):
    text = "".join(map(chr, range(40, 126))) * 2
    rows = [(5, text), (5, text), (None, text), (7, None), (None, None), (9, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in remove_repeats(docs).collect()), key=str)
    own = plain([(5, text)])[5]
    assert got == sorted([(5, *own[1:]), (5, *own[1:]), (None, 172, 172, 1), (7, 0, 0, 0), (None, 0, 0, 0), (9, 5, 0, 0)], key=str)
    assert remove_repeats(docs.limit(0)).count() == 0


def test_every_period(spark):
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    rows = []
    for period in range(1, 101):
        for n in (100 + period - 1, 100 + period, 100 + 2 * period + 7):
            part = "".join(rng.choice(letters) for _ in range(period))  # found in one text only
            rows.append((len(rows), (part * (n // period + 1))[:n]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in remove_repeats(docs).collect()}
    assert got == plain(rows)
