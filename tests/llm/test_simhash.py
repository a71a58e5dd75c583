import random
import re

import numpy as np
import xxhash

from amity.llm.components import components
from amity.llm.simhash import (
    block_masks,
    fingerprint,
    gray_rank,
    gray_rank_column,
    near_duplicates,
    near_links,
    shingle_hashes,
    spanning_links,
)


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, distance=4):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, x in enumerate(values):
        for y in values[i + 1 :]:
            if (x ^ y).bit_count() <= distance:
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {v: find(v) for v in values}


def clustered(rng, n, spread):
    centres = [rng.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    out = set()
    while len(out) < n:
        v = rng.choice(centres)
        for _ in range(rng.randint(0, spread)):
            v ^= 1 << rng.randrange(64)
        out.add(v)
    return sorted(out)


def test_fingerprints():
    rng = random.Random(1)
    texts = ["", " \t\x0b", "one", "A b c D é É", "x y\x1cz w v"]
    texts += [" ".join(rng.choice("aA bB é the THE x\x1f".split()) for _ in range(rng.randint(1, 200))) for _ in range(60)]
    for t in texts:
        assert fingerprint(shingle_hashes(t)) == plain_print(t)
    assert fingerprint(shingle_hashes("w x y z " * 9000)) == plain_print("w x y z " * 9000)


def test_gray_rank_inverts_the_code(spark):
    n = np.arange(3000, dtype=np.uint64)
    assert (gray_rank(n ^ (n >> np.uint64(1))) == n).all()
    values = [0, 1, 5, -1, -(1 << 63), (1 << 63) - 1, 12345678912345]
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    order = [r.fp for r in df.orderBy(gray_rank_column(df.fp)).collect()]
    ranks = gray_rank(np.array(values, np.int64).view(np.uint64))
    assert order == [values[i] for i in np.argsort(ranks)]


def test_two_blocks_always_agree():
    rng = random.Random(2)
    for _ in range(500):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), 4):
            y ^= 1 << b
        assert any(x & m == y & m for m in block_masks(4))


def test_tree_keeps_components():
    rng = random.Random(3)
    for spread in (3, 6, 12, 40):
        values = clustered(rng, 500, spread)
        links = spanning_links(np.array(values, np.uint64), None, 4)
        assert len(links) < len(values)
        want = plain_components(values)
        root = {v: v for v in values}

        def find(v, root=root):
            while root[v] != v:
                v = root[v]
            return v

        for x, y in links:
            a, b = sorted((find(x), find(y)))
            root[b] = a
        assert {v: find(v) for v in values} == want
    left, right = np.array(values[:250], np.uint64), np.array(values[250:], np.uint64)
    for x, y in spanning_links(left, right, 4):
        assert want[x] == want[y]


def test_links_with_large_buckets(spark):
    values = clustered(random.Random(4), 700, 8)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    want = plain_components(values)
    for large in (5, 100_000):
        got = {r.node: r.component for r in components(near_links(df, large=large)).collect()}
        groups = {}
        for v, s in zip(values, signed):
            groups.setdefault(want[v], set()).add(got.get(s, s))
        assert all(len(g) == 1 for g in groups.values())
        assert len(set().union(*groups.values())) == len(groups)


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(0, 60)] + [(500, x) for x in range(501, 600)] + [(7, 7), (900, 900)]
    links += [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(80)]
    rng.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {x: x for p in links for x in p}
    for _ in range(100):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(spark):
    rng = random.Random(6)
    base = [" ".join(rng.choice(["w%d" % i for i in range(500)]) for _ in range(300)) for _ in range(25)]
    texts = base + base[:5] + [b + " tail" for b in base[:8]] + ["head " + b for b in base[:4]] + ["", None, "  ", "x", "x"]
    rows = [(100 - i, t, "c", 1) for i, t in enumerate(texts)]
    rows += [(None, "only"), (None, base[0]), rows[0][:2]]
    rows = [(*r, "c", 1)[:4] for r in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string, fp int")
    prints = sorted({plain_print(t) for _, t, *_ in rows})
    roots = plain_components(prints)
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            r = roots[plain_print(t)]
            least[r] = min(least.get(r, i), i)
    want = sorted(((i, plain_print(t), least.get(roots[plain_print(t)])) for i, t, *_ in rows), key=str)
    got = [(r.doc_id, r.fingerprint % (1 << 64), r.component) for r in near_duplicates(docs).collect()]
    assert sorted(got, key=str) == want
    assert near_duplicates(docs.limit(0)).count() == 0
