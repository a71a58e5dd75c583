import random

import pytest

from amity.llm.toxicity import Model, Weights, fit, labelled_sample, maximal_segments, score_documents


def plain_segments(scores):
    """By definition: recursively the best contiguous run, the shortest and first of equals."""
    def best(a, b):
        found, top = None, 0.0
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > top:
                    found, top = (i, j + 1), total
        return found

    def walk(a, b):
        run = best(a, b)
        return [] if run is None else [*walk(a, run[0]), run, *walk(run[1], b)]

    return walk(0, len(scores))


def test_segments_against_their_definition():
    rng = random.Random(1)
    for _ in range(300):
        scores = [float(rng.choice([-7.3, -3.1, -1.7, -1.13, 1.31, 2.57, 5.19])) + rng.random() / 9 for _ in range(rng.randint(0, 25))]
        got = maximal_segments(scores)
        assert [(s, e) for s, e, _ in got] == plain_segments(scores)
        for s, e, total in got:
            assert total == pytest.approx(sum(scores[s:e]))


def test_passages_are_code_points():
    model = Model({"bad": 5.0, "worse": 5.0}, -1.0)
    text = "é\U0001f600 fine Bad, WORSE! fine"
    found = model.passages(text, model.segments(text, Weights(model.weights, model.rest)))
    assert [(s, e, x) for s, e, x, _ in found] == [(8, 18, 10.0)]


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        toxic = i % 7 == 0
        for _ in range(rng.randint(2, 4) if toxic else 0):
            text.insert(rng.randint(0, len(text)), rng.choice(["vile", "foul", "scorn" + rng.choice("abc")]))
        rows.append((i, " ".join(text), "x"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_learns_and_scores(spark):
    rows, labels = corpus(1200, 1)
    docs = spark.createDataFrame([*rows, (9001, None, "x"), (9002, "", "x"), (None, "vile foul", "x")], "doc_id long, text string, toxicity string")
    known = [x for x in labels if x[0] % 5] + [(None, 1), (77, None), (78, 9), (7, 1), (7, 1)]
    known = spark.createDataFrame(known, "doc_id long, toxic int")
    model = fit(docs, known)
    scored = {(r.doc_id, r.text): r for r in score_documents(docs, model).collect()}
    assert len(scored) == 1203
    wrong = sum((scored[(i, t)].toxicity >= 0.5) != dict(labels)[i] for i, t, _ in rows if i % 5 == 0)
    assert wrong <= 4
    assert all(0 <= r.toxicity <= 1 for r in scored.values())
    assert scored[(9001, None)].toxicity == scored[(9002, "")].toxicity < 0.5
    assert scored[(None, "vile foul")].passages


def test_no_labels_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert {r.toxicity for r in score_documents(docs, fit(docs, labels.limit(0))).collect()} == {0.5}
    assert all(r.toxicity < 0.5 for r in score_documents(docs, fit(docs, labels)).collect())
    assert score_documents(docs.limit(0), fit(docs.limit(0), labels)).count() == 0


def test_sample_is_bounded(spark):
    labels = spark.createDataFrame([(i, i % 3 == 0) for i in range(300)], "doc_id long, b boolean").selectExpr("doc_id", "int(b) toxic")
    drawn = labelled_sample(labels, 20, "doc_id", "toxic").collect()
    assert len(drawn) == 40 and {r.part for r in drawn} == {0, 1}
