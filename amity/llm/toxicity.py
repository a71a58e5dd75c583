"""Toxic passages as maximum-scoring segments of token log-odds.

**Weights.** The documents with a token or prefix are counted in a bounded sample
of toxic and other documents. A weight is the log of its rate in toxic over that
in other documents. Both counts have a Dirichlet prior: its mass follows the
token's rate in all documents, its split between the classes the odds of the
token's next shorter prefix, so that inflected forms borrow from their stem.
Weights that differ from zero by less than ``MIN_Z`` deviations are left out. A token
takes the weight of its longest known form; all other tokens share the rest of
both classes' mass, which makes the expected score of ordinary text negative.

**Segments.** One linear scan finds all maximal scoring segments of a document.

**Calibration.** Segment scores of ordinary text follow an extreme-value law,
``E = K * n * exp(-lambda * S)`` for ``n`` tokens. ``lambda`` solves
``sum(p * exp(lambda * s)) = 1`` over the scores of ordinary documents, ``K`` comes from the median of
their best segments. A document's evidence is ``-log P`` of its best segment
and ``-log E`` of each further significant one. A logistic curve of that sum's
logarithm, fitted on sampled documents that the weights have not seen, is the
score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_PER_LABEL = 20_000
PREFIXES = (7, 5, 4, 3)
SHORT_FIRST = PREFIXES[::-1]
SHORTEST = SHORT_FIRST[0]
MIN_TOXIC = 6  # a form must be seen as often in toxic documents
MIN_Z = 3.0
PRIOR_SHARE = 1.0  # the prior's mass, as a share of the toxic documents
TOKEN = re.compile(r"[^\W_]+")
FLUSH_AT = 300_000
UNLABELLED = -1


def forms(token: str) -> list[str]:
    """The token and its prefixes, longest first."""
    return [token, *(token[:n] + "*" for n in PREFIXES if len(token) > n)]


def beginnings(known: Iterable[str]) -> frozenset[str]:
    """How tokens with one of the known forms begin."""
    return frozenset(f.rstrip("*")[:SHORTEST] for f in known)


class Weights(dict):
    """A raw token's weight by looking it up."""

    def __init__(self, by_form: dict[str, float], rest: float):
        super().__init__()
        self.by_form, self.rest = by_form, rest
        self.begin = beginnings(by_form)

    def __missing__(self, raw: str) -> float:
        if len(self) >= FLUSH_AT:
            self.clear()
        token, weight = raw.lower(), self.rest
        if token[:SHORTEST] in self.begin:
            weight = next((self.by_form[f] for f in forms(token) if f in self.by_form), weight)
        self[raw] = weight
        return weight


class Forms(dict):
    """A raw token's counted forms by looking it up: the wanted ones, or all.

    A wanted form's shorter prefixes are wanted too, as they are at least as frequent; so the
    first one that isn't ends the search.
    """

    def __init__(self, wanted: frozenset[str] | None):
        super().__init__()
        self.wanted = wanted

    def __missing__(self, raw: str) -> tuple[str, ...]:
        if len(self) >= FLUSH_AT:
            self.clear()
        token = raw.lower()
        found = self[raw] = tuple(forms(token) if self.wanted is None else self._known(token))
        return found

    def _known(self, token: str) -> list[str]:
        found = []
        for n in SHORT_FIRST:
            if len(token) <= n:
                break
            if (form := token[:n] + "*") not in self.wanted:
                return found
            found.append(form)
        if token in self.wanted:
            found.append(token)
        return found


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (start, end, score), in order; linear time."""
    found: list[list] = []  # start, end, sum before start, sum at end, index of the last with a lower sum before
    sums = list(accumulate(scores, initial=0.0))
    for at in [i for i, score in enumerate(scores) if score > 0]:
        start, end, left, right = at, at + 1, sums[at], sums[at + 1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                found.append([start, end, left, right, j])
                break
            start, left = found[j][0], found[j][2]
            del found[j:]
    return [(s, e, right - left) for s, e, left, right, _ in found]


@dataclass(frozen=True)
class Model:
    """What scoring needs; its size is bounded by the sample."""

    weights: dict[str, float]
    rest: float
    decay: float = 1.0  # lambda
    k: float = 0.1
    slope: float = 1.0
    offset: float = 0.0

    def segments(self, text: str, weights: Weights) -> list[tuple[int, int, float, float]]:
        """(start, end, score, E) of each maximal segment, in tokens."""
        scores = list(map(weights.__getitem__, TOKEN.findall(text)))
        if not scores or max(scores) <= 0:
            return []
        n = len(scores)
        return [
            (s, e, score, self.k * n * math.exp(-self.decay * score)) for s, e, score in maximal_segments(scores)
        ]

    @staticmethod
    def passages(text: str, segments: list[tuple[int, int, float, float]]) -> list[tuple[int, int, float, float]]:
        """The significant segments, in code points."""
        significant = [x for x in segments if x[3] < 1]
        if not significant:
            return []
        places = [m.span() for m in TOKEN.finditer(text)]
        return [(places[s][0], places[e - 1][1], score, expected) for s, e, score, expected in significant]

    @staticmethod
    def evidence(segments: list[tuple[int, int, float, float]]) -> float:
        expected = sorted(e for *_, e in segments)
        if not expected:
            return 0.0
        best = -math.log(max(-math.expm1(-expected[0]), 1e-300))
        return math.log1p(best + sum(-math.log(max(e, 1e-300)) for e in expected[1:] if e < 1))

    def score(self, evidence: float) -> float:
        x = self.slope * evidence + self.offset
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def labelled_sample(labels: DataFrame, per_label: int, id_col: str, label_col: str) -> DataFrame:
    """``id_col, label, part``: at most ``per_label`` documents of each label, by the hash of the
    id. Other labels than 0 and 1 and NULL ids are no labels; a document with both counts as
    toxic. ``part`` 0 is for calibration, 1 for the weights."""
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias(id_col))
        .agg(F.max(label_col).cast("int").alias("label"))
        .withColumn("hash", F.xxhash64(F.col(id_col)))
    )
    drawn = [known.where(F.col("label") == x).orderBy("hash", id_col).limit(per_label) for x in (0, 1)]
    return drawn[0].unionByName(drawn[1]).select(
        id_col, "label", F.when(F.pmod("hash", F.lit(4)) == 0, 0).otherwise(1).alias("part")
    )


def _counts(docs: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
    """``form, label, n`` of documents (``text, label``): in how many a form occurs, for the wanted
    forms (with all their shorter ones) or all; the documents themselves under the empty form, and of
    labels 0 and 1 their different tokens under a blank."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens: dict[int, Counter] = {}
        known = Forms(wanted)

        def flush() -> pa.RecordBatch:
            rows = []
            for label, seen in tokens.items():
                rows += [(form, label, n) for form, n in seen.items()]
            tokens.clear()
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64()), strict=True)],
                ["form", "label", "n"],
            )

        for batch in batches:
            for value, label in zip(batch.column(0), batch.column(1), strict=True):
                own = set(TOKEN.findall(value.as_py() or ""))
                label = label.as_py()
                seen = tokens.setdefault(label, Counter())
                seen.update(set(chain.from_iterable(map(known.__getitem__, own))))
                seen[""] += 1
                if label != UNLABELLED:
                    seen[" "] += len(set(map(str.lower, own)))
                if sum(map(len, tokens.values())) >= FLUSH_AT:
                    yield flush()
        yield flush()

    return docs.select("text", "label").mapInArrow(count, "form string, label int, n long").groupBy(
        "form", "label"
    ).agg(F.sum("n").alias("n"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    per_label: int = SAMPLE_PER_LABEL,
    id_col: str = "doc_id",
    text: str = "text",
    label_col: str = "toxic",
) -> Model:
    """A model from the labelled documents and the token counts of all of ``docs``.

    ``per_label`` bounds the labelled documents used, and with them the model.
    Without documents of both labels nothing is learnt: every score is the share
    of toxic labels, or 0.5 without any. NULL texts are empty.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    shares = {r["label"]: r["n"] for r in labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
              .groupBy(id_col).agg(F.max(label_col).cast("int").alias("label"))
              .groupBy("label").agg(F.count("*").alias("n")).collect()}
    base = (shares.get(1, 0) + 0.5) / (sum(shares.values()) + 1)
    # At most 2 * per_label rows, so the broadcast is bounded.
    sample = labelled_sample(labels, per_label, id_col, label_col).withColumnRenamed(id_col, "id")
    drawn = texts.join(F.broadcast(sample), "id")

    # Toxic documents say which forms matter; one pass over all documents counts these, the
    # sample's other documents by themselves.
    toxic = _counts(drawn.where("part = 1 AND label = 1"), None).where(F.col("n") >= MIN_TOXIC)
    seen = {0: {}, 1: {r["form"]: r["n"] for r in toxic.collect()}}
    wanted = frozenset(seen[1]) - {"", " "}
    other = sample.where("part = 1 AND label = 0").select("id", "label")
    labelled = texts.join(F.broadcast(other), "id", "left")
    corpus: dict[str, int] = Counter()
    for r in _counts(labelled.select("text", F.coalesce("label", F.lit(UNLABELLED)).alias("label")), wanted).collect():
        corpus[r["form"]] += r["n"]
        if r["label"] == 0:
            seen[0][r["form"]] = r["n"]
    totals = [seen[x].pop("", 0) for x in (0, 1)]
    tokens = [max(1, seen[x].pop(" ", 0)) for x in (0, 1)]
    if not totals[0] or not totals[1]:
        return Model({}, 0.0, slope=0.0, offset=math.log(base / (1 - base)))
    weights, rest = _weights(seen, totals, tokens, corpus)
    return _calibrated(Model(weights, rest), drawn.where("part = 0"), shares)


def _weights(
    seen: dict, totals: list[int], tokens: list[int], corpus: dict[str, int]
) -> tuple[dict[str, float], float]:
    mass, all_docs = PRIOR_SHARE * totals[1], max(1, corpus.get("", 0))
    odds: dict[str, float] = {}
    weights: dict[str, float] = {}
    # Shorter forms come first, as the longer ones start from theirs.
    for form in sorted(seen[1], key=lambda f: (not f.endswith("*"), len(f))):
        token = form.rstrip("*")
        parent = next((token[:n] + "*" for n in PREFIXES if n < len(token) and token[:n] + "*" in odds), None)
        lean = odds.get(parent, 0.0)
        prior = mass * corpus.get(form, 1) / all_docs
        toxic = seen[1][form] + prior * math.exp(lean / 2)
        other = seen[0].get(form, 0) + prior * math.exp(-lean / 2)
        odds[form] = math.log(toxic / (totals[1] + mass)) - math.log(other / (totals[0] + mass))
        # An informed prior may be far below one document; it is no evidence of that size.
        if abs(odds[form]) >= MIN_Z * math.sqrt(1 / (toxic + 0.5) + 1 / (other + prior + 0.5)):
            weights[form] = odds[form]
    words = [f for f in weights if not f.endswith("*")]
    covered = [min(0.9, sum(seen[x].get(f, 0) for f in words) / tokens[x]) for x in (0, 1)]
    return weights, min(-0.05, math.log(1 - covered[1]) - math.log(1 - covered[0]))


def _calibrated(model: Model, drawn: DataFrame, shares: dict[int, int]) -> Model:
    """``model`` with the extreme-value law and the logistic curve of the drawn documents, whose
    number is bounded."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(model.weights, model.rest)
        for batch in batches:
            best, n, values, lists = [], [], [], []
            for value in batch.column(0):
                scores = list(map(weights.__getitem__, TOKEN.findall(value.as_py() or "")))
                segments = [s for *_, s in maximal_segments(scores)]
                lists.append(segments)
                best.append(max(segments, default=0.0))
                n.append(len(scores))
                values.append([s for s in scores if s > 0])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(n, pa.int64()), pa.array(best, pa.float64()),
                 pa.array(lists, pa.list_(pa.float64())), pa.array(values, pa.list_(pa.float64()))],
                ["label", "n", "best", "segments", "positive"],
            )

    rows = drawn.select("text", "label").mapInArrow(
        look, "label int, n long, best double, segments array<double>, positive array<double>"
    ).collect()
    plain = [r for r in rows if r["label"] == 0 and r["n"]]
    if not plain:
        return model
    ups = np.array([x for r in plain for x in r["positive"]])
    tokens = sum(r["n"] for r in plain)

    def excess(decay: float) -> float:
        return float(np.exp(np.minimum(decay * ups, 500)).sum() + (tokens - len(ups)) * math.exp(decay * model.rest)) / tokens - 1

    low, high = 1e-3, 4.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    decay = max(0.05, (low + high) / 2)
    k = math.log(2) * math.exp(float(np.median([decay * r["best"] - math.log(r["n"]) for r in plain])))
    model = Model(model.weights, model.rest, decay, k)

    def evidence(r) -> float:
        return model.evidence([(0, 0, s, k * r["n"] * math.exp(-decay * s)) for s in r["segments"]])

    x = np.array([evidence(r) for r in rows])
    y = np.array([float(r["label"]) for r in rows])
    drawn_of = [max(1, int((y == v).sum())) for v in (0, 1)]
    weight = np.where(y == 1, shares.get(1, 0) / drawn_of[1], shares.get(0, 0) / drawn_of[0])
    weight = weight / weight.mean()
    slope, offset = _logistic(x, y, weight / weight.mean())
    return Model(model.weights, model.rest, decay, k, slope, offset)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset of the weighted logistic curve, by damped Newton steps."""

    def loss(b: np.ndarray) -> float:
        z = b[0] * x + b[1]
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + 1e-3 * (b**2).sum())

    b = np.array([1.0, -1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(b[0] * x + b[1], -30, 30)))
        h = weight * p * (1 - p)
        gradient = np.array([(weight * (p - y) * x).sum(), (weight * (p - y)).sum()]) + 2e-3 * b
        hessian = np.array([[(h * x * x).sum(), (h * x).sum()], [(h * x).sum(), h.sum()]]) + 2e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        while loss(b - step) > loss(b) and np.abs(step).max() > 1e-9:
            step = step / 2
        b = b - step
    return max(0.0, float(b[0])), float(b[1])


PASSAGES = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("score", T.DoubleType()), T.StructField("expected", T.DoubleType()),
]))


def score_documents(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1) and ``passages``: the significant segments (expected less
    than once in such a text) in code points, in order.

    Whole texts; NULL and empty ones have no passage and the score of no
    evidence. The model is broadcast; its size is bounded by the sample it came
    from. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c not in ("toxicity", "passages")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        weights = Weights(model.weights, model.rest)
        kind = pa.list_(pa.struct([
            ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())
        ]))
        for batch in batches:
            scores, passages = [], []
            for value in batch.column(batch.schema.get_field_index(text)):
                whole = value.as_py() or ""
                found = model.segments(whole, weights)
                scores.append(model.score(model.evidence(found)))
                passages.append([
                    {"start": s, "end": e, "score": x, "expected": n} for s, e, x, n in model.passages(whole, found)
                ])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in others),
                 pa.array(scores, pa.float64()), pa.array(passages, kind)],
                [*others, "toxicity", "passages"],
            )

    schema = T.StructType([
        *(docs.schema[c] for c in others), T.StructField("toxicity", T.DoubleType()), T.StructField("passages", PASSAGES)
    ])
    return docs.select(*others).mapInArrow(run, schema)
