import random

from amity.llm.maxscore import integer_components, top_k


def plain(vectors, k):
    """Brute force over (id, integer vector or None) rows."""
    out = set()
    usable = [(i, v) for i, v in vectors if i is not None and v is not None]
    for q in sorted({i for i, _ in usable if i % 50 == 0}):
        own = max(v for i, v in usable if i == q)
        best = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in usable if i != q)[:k]
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)}
    return out


def check(spark, rows, k=5, **more):
    df = spark.createDataFrame(rows, "vec_id long, vector array<bigint>")
    got = top_k(df, df.where("vec_id % 50 = 0"), len(rows), len(rows), k=k, **more)
    got = [tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain(rows, k)


def test_random_vectors_ties_and_copies(spark):
    rng = random.Random(3)
    rows = [(i, [rng.randint(-3, 3) for _ in range(8)]) for i in range(700)]
    rows += [(i + 1000, [1] * 8) for i in range(120)] + [(i + 2000, [0] * 8) for i in range(60)]
    rows += [(5000, None), (None, [1] * 8), (100, rows[100][1])]
    check(spark, rows, shard_rows=100)


def test_wide_and_negative(spark):
    rng = random.Random(4)
    rows = [(i, [int(rng.gauss(0, 40) * 3 ** (-j / 4)) for j in range(64)]) for i in range(900)]
    check(spark, rows, shard_rows=300)


def test_small_tables(spark):
    check(spark, [(0, [1, 2])])
    check(spark, [(0, [1, 2]), (1, [1, 2]), (50, [-1, 0])])
    check(spark, [(7, [1])])
    empty = spark.createDataFrame([], "vec_id long, vector array<bigint>")
    assert top_k(empty, empty, 0, 0).count() == 0


def test_components(spark):
    rows = [([0.1, -0.001],), ([float("nan")],), ([float("inf")],), ([1.0, None],), (None,), ([],)]
    df = spark.createDataFrame(rows, "e array<float>")
    got = [r[0] for r in df.select(integer_components(df.e)).collect()]
    assert got == [[25, -1], None, None, None, None, []]
