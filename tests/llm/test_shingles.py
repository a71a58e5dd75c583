import random

from amity.llm.shingles import near_copies


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and (not a and not b or len(a & b) >= 0.8 * len(a | b) > 0):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def test_copies_with_changed_words(spark):
    rng = random.Random(5)
    words = ["w%d" % i for i in range(500)]
    common = " ".join(rng.choice(words) for _ in range(40))
    texts = []
    for _ in range(40):
        text = [rng.choice(words) for _ in range(rng.choice([1, 3, 5, 30, 120, 500]))]
        texts.append(" ".join(text))
        for _ in range(rng.randint(0, 5)):
            copy = list(text)
            for at in rng.sample(range(len(copy)), int(len(copy) * rng.choice([0, 0.01, 0.02, 0.03, 0.05]))):
                copy[at] = rng.choice(words)
            texts.append(" ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
    texts += [common + " " + " ".join(rng.choice(words) for _ in range(n)) for n in range(40)]
    texts += [None, "", " \n", texts[0], texts[0]]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.component for r in near_copies(docs).collect()}
    want = plain(rows)
    assert got == want and len(set(want.values())) < 120
    assert near_copies(docs.limit(0)).count() == 0
