import random

import numpy as np
import pytest

from amity.llm.mixing import fit_rates, mix, token_count


def plain_rates(tokens, posterior, targets, steps=60):
    """The same descent in numpy."""
    n, p = np.array(tokens, float), np.array(posterior)
    r = np.ones(len(n))
    total = n.sum()
    goal = np.array(targets) / sum(targets) * total
    share = np.maximum((p * n[:, None]).sum(0) / total, 1e-9)
    for _ in range(steps):
        s = (p * (n * r)[:, None]).sum(0)
        if (np.abs(s - goal) <= 1e-6 * np.maximum(goal, 1)).all():
            break
        r = np.maximum(0, r - p @ ((s - goal) / (total * share)))
    return r


@pytest.mark.parametrize("targets", [[0.5, 0.3, 0.2], [0.05, 0.05, 0.9], [1, 1, 1]])
def test_rates(spark, targets):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.3, 0.3, 0.3], 300)
    n = rng.integers(0, 900, 300)
    df = spark.createDataFrame([(i, int(n[i]), p[i].tolist()) for i in range(300)], "i int, n_tokens long, posterior array<double>")
    got = [r.rate for r in fit_rates(df, targets).orderBy("i").collect()]
    assert min(got) >= 0
    totals = (p * (n * np.array(got))[:, None]).sum(0)
    assert totals / n.sum() == pytest.approx(np.array(targets) / sum(targets), abs=0.02)
    assert got == pytest.approx(plain_rates(n, p, targets), abs=1e-3)


def test_mix(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        good = i % 3 > 0
        words = ["".join(rng.choice("abcdef") for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(20, 90))]
        rows.append((i, " ".join(words) if good else " ".join(w.upper() + "!!" for w in words), "x", 1))
        if i % 2:
            labels.append((i, "good" if good else "bad"))
    rows += [(None, "a b", "x", 1), (9000, None, "x", 1), (9001, "", "x", 1), rows[0], rows[0]]
    labels += [(None, "good"), (7, None), (9, "other"), (123456, "bad"), labels[0], labels[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rate string, n_tokens int")
    got = mix(docs, spark.createDataFrame(labels, "doc_id long, domain string"), {"good": 0.9, "bad": 0.1}).collect()
    assert len(got) == len(rows)
    total = sum(r.n_tokens * r.rate for r in got)
    good = sum(r.n_tokens * r.rate * r.posterior[0] for r in got)
    assert good / total == pytest.approx(0.9, abs=1e-4)
    assert all((r.posterior[0] > 0.5) == (r.doc_id % 3 > 0) for r in got if r.doc_id is not None and r.doc_id < 600)
    assert all(abs(r.copies - r.rate) < 1 and r.rate >= 0 for r in got)
    assert len({(r.rate, r.copies) for r in got if r.doc_id == 0}) == 1
    assert {r.n_tokens for r in got if r.doc_id in (9000, 9001)} == {0}


def test_no_labels_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, domain string")
    got = mix(docs, labels, {"a": 0.5, "b": 0.5}).collect()
    assert [r.posterior for r in got] == [[0.5, 0.5]] * 2 and {r.rate for r in got} == {1.0}
    assert mix(docs.limit(0), labels, {"a": 0.5, "b": 0.5}).count() == 0
    empty = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert {r.rate for r in mix(empty, labels, {"a": 1, "b": 3}).collect()} == {1.0}


def test_token_count(spark):
    df = spark.createDataFrame([(" a\t b\n",), ("",), (" \n",), ("one",)], "t string")
    assert [r[0] for r in df.select(token_count(df.t)).collect()] == [2, 0, 0, 1]
