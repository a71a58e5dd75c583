import numpy as np
import pytest

from amity.llm import crosspolytope as X
from amity.llm.queries import QUERIES


def table(spark, ids, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def dot(a, b):
    """Summed up one by one; ``sum`` itself would carry the lost bits along."""
    total = 0.0
    for x, y in zip(a, b):
        total += float(x) * float(y)
    return total


def plain(ids, vectors, queries, k):
    """Brute force: (query, rank, id, score), sums from the first component to the last."""
    out = []
    for q in queries:
        own = vectors[ids.index(q)]
        scores = {(-dot(own, v), i) for i, v in zip(ids, vectors) if i != q}
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def check(spark, ids, vectors, k=20, least=0.9, every=20):
    """Recall against brute force; every list has its full length, order and exact scores."""
    df = table(spark, ids, vectors)
    got = [tuple(r) for r in X.neighbours(df.repartition(5), df.where(df.vec_id % every == 0), k=k).collect()]
    queries = [i for i in ids if i % every == 0]
    want = plain(ids, vectors, queries, k)
    assert sorted(r[:2] for r in got) == sorted(r[:2] for r in want)
    by_id = dict(zip(ids, vectors))
    for q, _, i, score in got:
        assert i != q and score == dot(by_id[q], by_id[i])
    lists = sorted(got)
    for (q, _, i, s), (q2, _, i2, s2) in zip(lists, lists[1:]):
        assert q != q2 or (-s, i) < (-s2, i2)
    # By score, as equal ones stand for each other.
    worst = {q: s for q, _, _, s in want}
    assert np.mean([s >= worst[q] for q, _, _, s in got]) >= least


def test_hadamard():
    x = np.random.default_rng(1).normal(size=(5, 16))
    signs = np.array([[(-1) ** bin(i & j).count("1") for j in range(16)] for i in range(16)]) / 4
    assert np.allclose(X.hadamard(x), x @ signs)


@pytest.mark.parametrize("n_rows", [10, 5_000, 300_000])
def test_probes_are_all_buckets_of_promise(n_rows):
    """Pruned search of buckets against all of them, with one hash and with several."""
    hashes = X.CrossPolytope(6, n_rows, tables=2)
    assert hashes.buckets * X.BUCKET_ROWS >= n_rows
    vectors = np.random.default_rng(4).normal(size=(4, 6))
    threshold = 0.6 * len(hashes.looks)
    found, own = hashes.probes(vectors, threshold), hashes.codes(vectors)
    promise = []
    for t in range(2):
        total = np.zeros((4, 1))
        for axes in hashes.promises(vectors, t):
            total = (total[:, :, None] + axes[:, None, :]).reshape(4, -1)
        promise.append(total)
    promise = np.hstack(promise)
    for i in range(4):
        assert set(found[i]) == set(np.flatnonzero(promise[i] >= threshold)) | set(own[i])
        best = max(promise[i, c] for c in own[i])
        assert hashes.promise_of(vectors[i : i + 1], own[i : i + 1])[0] == pytest.approx(best)


def test_own_bucket_is_the_nearest_axis():
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(200, 5)) * 10.0 ** rng.integers(-300, 150, (200, 1))
    hashes = X.CrossPolytope(5, 100, tables=3)
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit = np.pad(unit / np.linalg.norm(unit, axis=1, keepdims=True), ((0, 0), (0, 3)))
    for t in range(3):
        turned = unit
        for signs in hashes.signs[t, 0]:
            turned = X.hadamard(turned * signs)
        code = hashes.codes(vectors)[:, t] - t * hashes.buckets
        chosen = turned[np.arange(200), code % 8] * np.where(code < 8, 1, -1)
        assert np.allclose(chosen, np.abs(turned).max(axis=1), rtol=0, atol=1e-12)


def test_random_and_clustered(spark):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(3000, 24))
    vectors[1000:2000] = vectors[0] + 0.05 * rng.normal(size=(1000, 24))  # a third in one place
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    check(spark, list(range(3000)), vectors)


def test_other_lengths_and_sizes(spark):
    """Not of unit length, and components that differ in size: the threshold is fitted all the same."""
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(2000, 10)) * rng.exponential(size=(2000, 1)) * np.arange(1, 11)
    check(spark, list(range(2000)), vectors, k=10)


def test_large_buckets_and_crowded_cells_are_cut(spark, monkeypatch):
    """Several cells for a bucket and several parts of the queries change nothing."""
    rng = np.random.default_rng(8)
    vectors = np.concatenate([rng.normal(size=(900, 8)), [1, 0, 0, 0, 0, 0, 0, 0] + 1e-3 * rng.normal(size=(600, 8))])
    df = table(spark, range(1500), vectors)
    asked = df.where("vec_id % 5 = 0")
    whole = sorted(map(tuple, X.neighbours(df, asked, k=7).collect()))
    monkeypatch.setattr(X, "CELL_ROWS", 50)
    monkeypatch.setattr(X, "CELL_QUERIES", 20)
    monkeypatch.setattr(X, "HELD_PAIRS", 100)
    assert sorted(map(tuple, X.neighbours(df, asked, k=7).collect())) == whole


def test_copies(spark):
    """One vector in a third of all rows: each list has the smallest ids."""
    rng = np.random.default_rng(9)
    vectors = [[1.0, 2.0, 3.0]] * 500 + (0.3 * rng.normal(size=(900, 3))).tolist() + [[1.0, 2.0, 3.0]] * 100
    ids = list(range(1500))
    df = table(spark, ids, vectors)
    got = X.neighbours(df, df.where("vec_id IN (0, 3, 1499)"), k=6).orderBy("query_id", "rank").collect()
    near = {0: [1, 2, 3, 4, 5, 6], 3: [0, 1, 2, 4, 5, 6], 1499: [0, 1, 2, 3, 4, 5]}
    better = [i for i, v in enumerate(vectors) if np.dot(v, [1, 2, 3]) > 14]
    assert not better
    assert [r["vec_id"] for r in got] == sum(near.values(), [])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    ids = [0, 1, 2, 20, 40, 60, 80, 100, None, 3, 20, 1, 120]
    vectors = [[1, 0], [0.5, 0.5], [1], [0, 1, 0], None, [0, 0], [nan, 1], [inf, 1], [1, 1], [None, 1], [0, 2], [0.5, 0.5], []]
    df = table(spark, ids, vectors).selectExpr("*", "vec_id AS id", "1 AS v", "vec_id AS code", "'x' AS score")
    got = sorted(map(tuple, X.neighbours(df, df.where("vec_id % 20 = 0"), k=5).collect()))
    assert got == [
        (0, 1, 2, 1.0), (0, 2, 1, 0.5), (0, 3, 20, 0.0),
        (20, 1, 1, 1.0), (20, 2, 0, 0.0), (20, 3, 2, 0.0),
    ]


def test_small_tables(spark):
    for n in (0, 1, 2, 7):
        df = table(spark, range(n), [[i + 1.0, 1.0] for i in range(n)]) if n else spark.createDataFrame([], "vec_id long, embedding array<float>")
        got = X.neighbours(df, df.where("vec_id % 3 = 0"), k=4)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted(map(tuple, got.collect())) == sorted(plain(list(range(n)), [[i + 1.0, 1.0] for i in range(n)], range(0, n, 3), 4))


def test_query_recall(spark):
    """Of the given vectors, near to no other, which is the hard case."""
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op13_cross_polytope"](spark, folder).collect()
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, vectors = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], float)
    queries = [i for i in ids if i % 20 == 0]
    want = {r[::2][:2] for r in plain(ids, vectors, queries, 20)}
    assert len(got) == len(want) and len({(r["query_id"], r["vec_id"]) for r in got} & want) >= 0.9 * len(want)
