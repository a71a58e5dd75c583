"""Mixing documents to target domain weights with soft memberships.

A classifier learns the domains from a labelled table: a few measures of the
text, cut at the labelled rows' quantiles, and the count of each cell per domain
with one added (naive Bayes). It gives every document a posterior over the domains.

Each document ``i`` of ``n[i]`` tokens gets a rate ``r[i] >= 0``, how often it is
to be used. The rates minimise

    sum over k of (sum over i of r[i] * n[i] * p[i, k] - T[k])**2 / share[k]

by projected gradient steps from ``r = 1``, in the metric of the token counts, so
that a document's rate follows from its posterior and not from its length. A step
needs only the domains' expected totals, which are one distributed sum.

Everything is built from column functions.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amity.llm.tables import shared_table

BINS = 24
STEPS = 60
TOLERANCE = 1e-6
SIGNS = r"[\p{L}\p{N}\s]+"
NOT_CAPITAL = r"[^\p{Lu}]+"


def measures(text: Column) -> dict[str, Column]:
    """Numbers that tell domains apart, from one whole text."""
    chars = F.greatest(F.char_length(text), F.lit(1))
    words = F.split(text, " ")
    return {
        "signs": F.char_length(F.regexp_replace(text, SIGNS, "")) / chars,
        "capitals": F.char_length(F.regexp_replace(text, NOT_CAPITAL, "")) / chars,
        "variety": F.size(F.array_distinct(words)) / F.size(words),
        "word_length": chars / F.size(words),
        "length": F.log1p(F.char_length(text).cast("double")),
    }


def token_count(text: Column) -> Column:
    """White-space separated words."""
    trimmed = F.btrim(text, F.lit(" \t\n\r\x0b\x0c"))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"\s+"))).cast("bigint")


def _bin(measure: Column, edges: list[float]) -> Column:
    """The number of edges below the measure, as a position from 1."""
    return reduce(lambda a, b: a + b, (F.when(measure > e, 1).otherwise(0) for e in edges), F.lit(1))


def posteriors(measured: DataFrame, labelled: DataFrame, id_col: str, domains: list[str]) -> DataFrame:
    """``measured`` (the id and the measures) with ``posterior``, an array in the order of ``domains``.

    ``labelled`` has the id and ``domain``; other domains, NULLs and ids without
    document teach nothing. All labelled documents are counted; what reaches the
    driver is one number for each measure, bin and domain. Without labels every
    posterior is even.
    """
    names = list(measures(F.lit("")))
    taught = (
        labelled.where(F.col(id_col).isNotNull() & F.col("domain").isin(domains))
        .select(F.col(id_col), "domain")
        .distinct()
        .join(measured.select(id_col, *names), id_col)
    )
    taught = shared_table(taught)
    shares = [i / BINS for i in range(1, BINS)]
    found = taught.agg(*(F.percentile_approx(m, shares, F.lit(10_000)).alias(m) for m in names)).first()
    edges = {m: sorted(set(found[m] or [])) for m in names}
    cells = taught.select("domain", F.explode(F.array(*(
        F.struct(F.lit(m).alias("measure"), _bin(F.col(m), edges[m]).alias("bin")) for m in names
    ))).alias("x")).groupBy("domain", "x.measure", "x.bin").agg(F.count("*").alias("n"))
    counts = {(r["domain"], r["measure"], r["bin"]): r["n"] for r in cells.collect()}
    of = {d: sum(n for (k, m, _), n in counts.items() if k == d and m == names[0]) for d in domains}
    total = sum(of.values())

    def log_odds(domain: str) -> Column:
        start = math.log((of[domain] + 1) / (total + len(domains)))
        parts = [F.lit(start)]
        for m in names:
            width = len(edges[m]) + 1
            row = [math.log((counts.get((domain, m, b), 0) + 1) / (of[domain] + width)) for b in range(1, width + 1)]
            parts.append(F.element_at(F.array(*map(F.lit, row)), F.col(f"{m}_bin")))
        return reduce(lambda a, b: a + b, parts)

    binned = measured.withColumns({f"{m}_bin": _bin(F.col(m), edges[m]) for m in names})
    raw = binned.withColumn("raw", F.array(*map(log_odds, domains)))
    top = F.array_max("raw")
    odds = F.transform("raw", lambda x: F.exp(x - top))
    whole = F.aggregate("odds", F.lit(0.0), lambda a, x: a + x)
    return (
        raw.withColumn("odds", odds)
        .withColumn("posterior", F.transform("odds", lambda x: x / whole))
        .drop("raw", "odds", *(f"{m}_bin" for m in names))
    )


def fit_rates(
    rows: DataFrame, targets: list[float], total: float | None = None, steps: int = STEPS
) -> DataFrame:
    """``rows`` (``n_tokens, posterior``) with ``rate``.

    ``targets`` are the domains' weights; they are scaled to ``total`` tokens, by
    default as many as there are. Steps end when every total is within ``TOLERANCE``
    of its target, or after ``steps``: targets that no rates meet are met as
    closely as the steps get. Without tokens all rates are 1.
    """
    k = range(len(targets))
    p = [F.col("posterior")[j] for j in k]

    def totals(rate: Column) -> list[float]:
        sums = rows.withColumn("rate", rate).agg(*(F.sum(F.col("rate") * F.col("n_tokens") * p[j]).alias(f"t{j}") for j in k)).first()
        return [float(x or 0) for x in sums]

    rate = F.lit(1.0)
    now = totals(rate)
    tokens = sum(now)
    if not tokens:
        return rows.withColumn("rate", rate)
    goal = [w / sum(targets) * (total or tokens) for w in targets]
    share = [max(x / tokens, 1e-9) for x in now]
    # The scaled Gram matrix has no eigenvalue above its greatest row sum, which is 1.
    for _ in range(steps):
        if all(abs(a - b) <= TOLERANCE * max(b, 1.0) for a, b in zip(now, goal, strict=True)):
            break
        pull = [(a - b) / (tokens * s) for a, b, s in zip(now, goal, share, strict=True)]
        rate = F.greatest(F.lit(0.0), rate - reduce(lambda a, b: a + b, (p[j] * pull[j] for j in k)))
        now = totals(rate)
    return rows.withColumn("rate", rate)


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    weights: dict[str, float],
    id_col: str = "doc_id",
    text: str = "text",
    total: float | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``id_col``, the columns ``keep``, ``n_tokens, posterior, rate`` and ``copies`` for each row of
    ``docs``.

    ``labelled`` has the id and a ``domain``; ``weights`` are the wanted shares of
    tokens. ``copies`` is the rate as a whole number, the fraction settled by the
    hash of id and text; equal rows get the same. NULL texts count as empty, with
    no tokens and the posterior of an empty text. An id without label is
    classified like the others, labels teach but do not decide.
    """
    domains = list(weights)
    whole = F.coalesce(F.col(text), F.lit(""))
    draw = F.pmod(F.xxhash64(F.col(id_col), whole, F.lit("mix")), F.lit(1 << 30)) / (1 << 30)
    measured = docs.select(
        id_col, *keep, token_count(whole).alias("n_tokens"), draw.alias("draw"), *(c.alias(m) for m, c in measures(whole).items())
    )
    # Numbers only; the texts are read once.
    measured = shared_table(measured)
    found = posteriors(measured, labelled, id_col, domains)
    rated = fit_rates(shared_table(found.select(id_col, *keep, "n_tokens", "draw", "posterior")), list(weights.values()), total)
    copies = F.floor("rate") + (F.col("draw") < F.col("rate") - F.floor("rate")).cast("int")
    return rated.select(id_col, *keep, "n_tokens", "posterior", "rate", copies.cast("int").alias("copies"))
