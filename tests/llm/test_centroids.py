import random
from hashlib import sha256
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F

from amity.llm import centroids as C
from amity.llm.queries import QUERIES


def plain_nearest(vectors, centroids):
    gaps = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids] for v in vectors]
    return [(row.index(min(row)), min(row)) for row in gaps]


def plain_fit(vectors, centroids, rounds):
    for _ in range(rounds):
        own = [i for i, _ in plain_nearest(vectors, centroids)]
        groups = [[v for v, o in zip(vectors, own) if o == i] for i in range(len(centroids))]
        centroids = [[sum(x) // len(g) for x in zip(*g)] if g else c for g, c in zip(groups, centroids)]
    return centroids


@pytest.mark.parametrize("dims", [1, 2, 5])
def test_search_with_ties(dims):
    """Small whole numbers: very many equal distances, equal centroids, vectors on centroids."""
    rng = random.Random(dims)
    for k in (1, 2, 3, 17, 40):
        centroids = [[rng.randint(-4, 4) for _ in range(dims)] for _ in range(k)]
        vectors = [[rng.randint(-6, 6) for _ in range(dims)] for _ in range(300)] + centroids
        got = C.Orchard(np.array(centroids)).nearest(np.array(vectors))
        assert list(zip(*map(list, got))) == plain_nearest(vectors, centroids)


def test_search_leaves_out_far_centroids():
    """With clusters apart, most of the centroids are never measured."""
    rng = np.random.default_rng(2)
    centroids = rng.integers(-100_000, 100_000, (40, 6))
    vectors = centroids[rng.integers(0, 40, 1000)] + rng.integers(-200, 200, (1000, 6))
    index, seen = C.Orchard(centroids), []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                seen.append(len(key))
            return np.asarray(self)[key]

    index.centroids = centroids.view(Counted)
    got = index.nearest(vectors)
    assert list(zip(*map(list, got))) == plain_nearest(vectors.tolist(), centroids.tolist())
    assert sum(seen) < 1000 * 12


def test_greatest_components():
    """No sum overflows at the bound."""
    most = C.greatest_component(3)
    centroids = np.array([[most] * 3, [-most] * 3, [0, 0, 0]])
    vectors = np.array([[-most] * 3, [most] * 3, [1, 2, 3], [most, -most, most]])
    got = C.Orchard(centroids).nearest(vectors)
    assert list(zip(*map(list, got))) == plain_nearest(vectors.tolist(), centroids.tolist())


def test_clusters(spark):
    rng = random.Random(12)
    rows = [(i, [rng.randint(-9, 9) for _ in range(4)]) for i in range(400)]
    rows += [(i, [3, 3, 3, 3]) for i in range(400, 700)]  # a third of all rows alike
    rows += [(1, rows[1][1]), (None, [1, 2, 3, 4]), (None, [1, 2, 3, 4])]  # repeated rows, NULL ids
    odd = [(900, None), (901, []), (902, [1, 2, 3]), (903, [1, 2, None, 4]), (904, [2**62, 0, 0, 0]), (905, [1, 2, 3, 4, 5])]
    df = spark.createDataFrame(rows + odd, "vec_id long, vector array<bigint>")
    df = df.withColumns({"cluster": F.lit("x"), "id": "vec_id", "v": F.lit(0), "distance": F.lit(1)})
    usable = C.usable(df.repartition(7), 4)
    start = C.first_centroids(usable, 9, F.coalesce("id", F.lit(-1)))
    first = sorted((-1 if i is None else i, v) for i, v in rows)[:9]
    assert start.tolist() == [v for _, v in first]
    fitted = C.fit_centroids(usable, start, 4)
    assert fitted.tolist() == plain_fit([v for _, v in rows], start.tolist(), 4)
    got = C.cluster(usable, fitted).collect()
    want = plain_nearest([v for _, v in rows], fitted.tolist())
    inertia = [sum(d for c, d in want if c == i) for i in range(9)]

    def key(row):
        return [(x is None, x) for x in row]

    expected = [(i, c, d, inertia[c], sum(inertia), tuple(fitted[c].tolist())) for (i, _), (c, d) in zip(rows, want)]
    assert sorted([(*r[:5], tuple(r[5])) for r in got], key=key) == sorted(expected, key=key)


def test_empty_clusters_stay(spark):
    df = spark.createDataFrame([(1, [0]), (2, [0]), (3, [9])], "vec_id long, vector array<bigint>")
    fitted = C.fit_centroids(C.usable(df, 1), np.array([[0], [0], [100], [8]]), 3)
    assert fitted.tolist() == [[0], [0], [100], [9]]


def test_no_rows(spark):
    rows = C.usable(spark.createDataFrame([(1, None)], "vec_id long, vector array<bigint>"), 3)
    start = C.first_centroids(rows, 5, F.col("id"))
    out = C.cluster(rows, C.fit_centroids(rows, start, 2))
    assert out.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"] and out.count() == 0


def test_sums_beyond_64_bits(spark):
    rows = C.usable(spark.createDataFrame([(i, [2**30 * (-1) ** i]) for i in range(8)], "vec_id long, vector array<bigint>"), 1)
    got = C.cluster(rows, np.array([[0]])).first()
    assert (got["distance"], got["cluster_inertia"], got["inertia"]) == (2**60, None, None)


def test_query(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(64)]) for i in range(150)]
    rows += [(150, None), (151, [0.5] * 63), (152, [float("nan")] * 64), (153, [None] * 64), (154, [float("inf")] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    kept = {
        r["vec_id"]: [floor(256 * x) for x in r["embedding"]]
        for r in df.collect()
        if r["embedding"] and len(r["embedding"]) == 64 and all(x is not None and isfinite(x) for x in r["embedding"])
    }
    assert len(kept) == 150
    start = sorted(kept, key=lambda i: sha256(f"2:{i}".encode()).hexdigest())[:40]
    fitted = plain_fit(list(kept.values()), [kept[i] for i in start], 5)
    near = dict(zip(kept, plain_nearest(list(kept.values()), fitted)))
    own = {c: sum(d for o, d in near.values() if o == c) for c in range(40)}
    want = [
        (i, c, d, own[c], sum(own.values()), sha256(",".join(map(str, fitted[c])).encode()).hexdigest())
        for i, (c, d) in near.items()
    ]
    out = QUERIES["op12_orchard"](spark, str(tmp_path))
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, out.collect())) == sorted(want)
