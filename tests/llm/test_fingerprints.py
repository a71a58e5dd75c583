import random

import numpy as np

from amity.llm.fingerprints import (
    PrefixHashes,
    as_text,
    code_points,
    common_extension,
    edited_fingerprints,
    fingerprints,
    likeness,
    sketch,
)


def test_spans_and_extensions():
    rng = random.Random(1)
    for _ in range(30):
        a = "".join(rng.choice("ab") for _ in range(60)) + "é\U0001f600"
        b = a[:rng.randint(0, 60)] + "x" + a
        p, q = PrefixHashes(code_points(a)), PrefixHashes(code_points(b))
        for _ in range(60):
            i, j = rng.randint(0, len(a)), rng.randint(0, len(b))
            n = rng.randint(0, min(len(a) - i, len(b) - j))
            assert (p.span(i, i + n) == q.span(j, j + n)) == (a[i : i + n] == b[j : j + n])
            want = 0
            while i + want < len(a) and j + want < len(b) and a[i + want] == b[j + want]:
                want += 1
            assert common_extension(p, i, q, j) == want


def test_likeness_follows_common_text():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh") for _ in range(6000))
    other = "".join(rng.choice("abcdefgh") for _ in range(6000))
    a, half, b = (sketch(code_points(t)) for t in (text, text[:3000] + other[:3000], other))
    assert likeness(a, a) == 1.0
    assert 0.3 < likeness(a, half) < 0.7
    assert likeness(a, b) < 0.05
    run = sketch(code_points("ab" * 5000))  # few different spans
    assert likeness(run, sketch(code_points("ab" * 4000))) > 0.9


def plain(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for at, (key, text) in enumerate(order):
        text, following = text or "", order[(at + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, changed, after = (sketch(code_points(t)) for t in (text, edited, following))
        out.append((key, len(text), edited, as_text(own), as_text(changed), likeness(own, changed), likeness(own, after)))
    return sorted(out, key=str)


def test_edited_texts(spark):
    rng = random.Random(5)
    rows = [(i * i, "".join(rng.choice("abcé \U0001f600") for _ in range(rng.choice([0, 1, 5, 40, 300])))) for i in range(90)]
    rows += [(None, "none"), (None, None), (4, "again"), (4, "again"), (7, None), (-3, "low " * 2000)]
    for given in (rows, rows[:1], rows[:2], [(1, None)]):
        for ranges in (1, 7):
            df = spark.createDataFrame([(a, b, "extra") for a, b in given], "doc_id long, text string, fingerprint string")
            got = sorted((tuple(r) for r in edited_fingerprints(df, ranges=ranges).collect()), key=str)
            assert got == plain(given)
    assert edited_fingerprints(df.limit(0)).count() == 0
    single = fingerprints(df.select("doc_id", "text")).first()
    assert single.fingerprint == as_text(sketch(np.array([], np.uint32)))
