"""Personal data: fixed forms, and terms that give them away.

E-mail addresses, IP addresses, card and phone numbers are found by pattern.
Each of their values is a protected entity. How far a term reveals an entity is
its pointwise mutual information with the entity over the information of the
entity itself, from counts over all documents:

    disclosure(t; e) = log(N * n(t, e) / (n(t) * n(e))) / log(N / n(e))

``n(t, e)`` counts documents with both, the term outside the fixed forms, ``n(t)`` and
``n(e)`` all with either. It is 1 for a term that is found only where the entity is.
Wherever they stand in a document with the entity, terms at or above ``GENERALISE_AT``
are replaced by a general word, those at or above ``REMOVE_AT`` are taken out. Fewer than
``MIN_SUPPORT`` different texts together are no evidence.

Everything is built from column functions. All patterns are possessive and
anchored at the start of a run, so that they take linear time and no stack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amity.llm.tables import pack, shared_table, unpack

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Runs with fewer than 13 digits can't be cards and are left out at once.
    "card": r"(?<![0-9])(?=(?:[0-9][ -]?){13})[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# What a text must contain for the pattern to be tried.
HINTS = {"email": "@", "phone": "+"}

NO_SPANS = "array<struct<start:int,end:int,value:string>>"

TERM = r"[\p{L}\p{N}]++"
MIN_TERM_CHARS = 3
MIN_SUPPORT = 4
GENERALISE_AT = 0.8
REMOVE_AT = 0.95


def spans_of(text: Column, pattern: str, wanted=None) -> Column:
    """Array of ``start, end, value`` of all matches, in code points, ends exclusive; of those
    only whose value is ``wanted``, a function to a condition.

    The texts between the matches come from splitting by the same pattern, and
    places are sums of lengths.
    """
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    nothing = F.array().cast(NO_SPANS)

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.char_length(pair["gap"])
        end = start + F.char_length(pair["value"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        found = F.concat(state["found"], F.array(span))
        if wanted is not None:
            found = F.when(wanted(pair["value"]), found).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    pairs = F.zip_with(
        values,
        F.slice(F.split(text, pattern), F.lit(1), F.size(values)),
        lambda value, gap: F.struct(value.alias("value"), gap.alias("gap")),
    )
    start = F.struct(F.lit(0).alias("at"), nothing.alias("found"))
    return F.when(
        F.size(values) > 0, F.aggregate(pairs, start, step, lambda state: state["found"])
    ).otherwise(nothing)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(number: Column) -> Column:
    """Every second digit from the right is doubled, and the sum of all digits ends in 0."""
    n = F.char_length(number)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(number, i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(
            F.split(value, r"\."),
            # Longer parts may have leading zeros.
            lambda part: F.char_length(F.regexp_replace(part, "^0+", "")).between(0, 3)
            & (F.coalesce(F.right(F.concat(F.lit("0"), part), F.lit(4)).try_cast("int"), F.lit(0)) <= 255),
        )
    count = F.char_length(digits(value))
    if kind == "card":
        return F.when(count.between(13, 19), passes_luhn(digits(value))).otherwise(False)
    return count.between(9, 15)


def base_spans(text: Column) -> Column:
    """Array of ``kind, start, end, value`` of the fixed forms, by kind as listed, then start."""
    return F.concat(*(_spans_of_kind(text, kind) for kind in KINDS))


def _spans_of_kind(text: Column, kind: str) -> Column:
    spans = spans_of(text, PATTERNS[kind])
    if kind in HINTS:
        spans = F.when(F.contains(text, F.lit(HINTS[kind])), spans).otherwise(F.array().cast(NO_SPANS))
    if kind != "email":
        spans = F.filter(spans, lambda s: _valid(kind, s["value"]))
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"], s["end"], s["value"]))


def _terms(text: Column) -> Column:
    """The different terms of a text in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def revealing_terms(texts: DataFrame) -> DataFrame:
    """``key, term, disclosure`` of the terms to hide in ``texts`` (``key, text, spans``).

    ``key`` stands for the text: support counts different texts, all other counts
    cover all documents. ``n(t, e)`` is ``n(e)`` at most, so a term on more than
    ``N**(1 - GENERALISE_AT) * n(e)**GENERALISE_AT`` documents can't reveal the entity,
    and one on fewer than ``MIN_SUPPORT`` has no evidence; both are left out before
    terms meet entities. Counts are merged before each shuffle, so an entity or a term
    in a third of all texts sends one row per task.
    """
    n_docs = texts.count()
    formed = texts.where(F.size("spans") > 0)
    entity = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], F.lower(s["value"])))
    held = formed.select("key", F.explode(F.array_distinct(entity)).alias("entity"))
    held = shared_table(held.groupBy("key", "entity").agg(F.count("*").alias("copies")))
    entities = (
        held.groupBy("entity")
        .agg(F.sum("copies").alias("n_entity"), F.count("*").alias("texts"))
        .where((F.col("texts") >= MIN_SUPPORT) & (F.col("n_entity") < n_docs))
        .withColumn("most", F.pow(F.lit(float(n_docs)), 1 - GENERALISE_AT) * F.pow("n_entity", GENERALISE_AT) * (1 + 1e-9))
        .drop("texts")
    )
    held = shared_table(held.join(entities, "entity"))
    most = held.agg(F.max("most")).first()[0] or 0.0
    outside = _terms(blanked(F.col("text"), F.col("spans")))
    # A term that touches a form is another one without it; the document has both.
    every = F.when(F.size("spans") > 0, F.array_union(_terms(F.col("text")), outside)).otherwise(_terms(F.col("text")))
    # Merged in each task first: what is shuffled is a task's vocabulary.
    counts = texts.select(F.explode(every).alias("term")).where(F.char_length("term") >= MIN_TERM_CHARS)
    counts = counts.groupBy("term").agg(F.count("*").alias("n_term")).where(F.col("n_term").between(MIN_SUPPORT, most))
    terms = formed.select("key", F.explode(outside).alias("term")).where(F.char_length("term") >= MIN_TERM_CHARS)
    terms = terms.join(shared_table(counts), "term").distinct()
    pairs = shared_table(terms.join(held, "key").where(F.col("n_term") <= F.col("most")).drop("most"))
    telling = (
        pairs.groupBy("entity", "term")
        .agg(
            F.sum("copies").alias("n_both"),
            F.count("*").alias("texts"),
            F.first("n_term").alias("n_term"),
            F.first("n_entity").alias("n_entity"),
        )
        .where(F.col("texts") >= MIN_SUPPORT)
        .withColumn("n_docs", F.lit(n_docs))
        .withColumn(
            "disclosure",
            F.log(F.col("n_docs") * F.col("n_both") / (F.col("n_term") * F.col("n_entity")))
            / F.log(F.col("n_docs") / F.col("n_entity")),
        )
        .where(F.col("disclosure") >= GENERALISE_AT)
        .select("entity", "term", "disclosure")
    )
    return pairs.join(telling, ["entity", "term"]).groupBy("key", "term").agg(F.max("disclosure").alias("disclosure"))


SPAN = "struct<kind:string,start:int,end:int,action:string>"


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``spans`` (kind, start, end, action) and ``sanitised``, the text without them.

    Spans of the fixed forms come first, by kind as listed and start, then those
    of kind ``term`` by start; a term ends where a fixed form begins. Fixed
    forms and general terms are replaced by their kind in brackets, revealing
    terms are removed. NULL texts count as empty and have no spans; equal rows
    stay, each with its spans. Other columns stay, whatever their names, but for ``spans`` and
    ``sanitised``, which are replaced.
    """
    if {"key", "whole", "terms"} & set(docs.columns):  # this function's own names
        others = docs.drop("spans", "sanitised")
        return unpack(sanitise(pack(others, text), text), others.columns, "spans", "sanitised")
    rows = docs.drop("spans", "sanitised").withColumn("whole", F.coalesce(F.col(text), F.lit("")))
    based = rows.withColumn("spans", base_spans(F.col("whole"))).withColumn(
        "key", F.concat(F.hex(F.xxhash64("whole")), F.hex(F.xxhash64(F.lit(1), F.col("whole"))))
    )
    hidden = revealing_terms(based.select("key", F.col("whole").alias("text"), "spans"))
    terms = hidden.groupBy("key").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("terms")
    )
    # Only texts with a fixed form can have terms; the others are spread by their other columns.
    spread = F.concat(F.lit("-"), F.hex(F.xxhash64(*[F.col(c) for c in rows.columns if c not in (text, "whole")])))
    joined = based.withColumn("key", F.when(F.size("spans") > 0, F.col("key")).otherwise(spread)).join(
        terms, "key", "left"
    )

    def named(kind: Column, span: Column, action: Column) -> Column:
        return F.struct(kind.alias("kind"), span["start"].alias("start"), span["end"].alias("end"), action.alias("action"))

    base = F.transform("spans", lambda s: named(s["kind"], s, F.lit("generalised")))
    found = F.when(
        F.col("terms").isNotNull(),
        spans_of(
            blanked(F.col("whole"), F.col("spans")), TERM, lambda value: F.map_contains_key(F.col("terms"), F.lower(value))
        ),
    )
    more = F.transform(
        found,
        lambda t: named(
            F.lit("term"),
            t,
            F.when(F.element_at("terms", F.lower(t["value"])) >= REMOVE_AT, F.lit("removed")).otherwise(F.lit("generalised")),
        ),
    )
    spans = F.concat(base, F.coalesce(more, F.array().cast(f"array<{SPAN}>")))
    return (
        joined.withColumn("spans", spans)
        .withColumn("sanitised", _without(F.col("whole"), F.col("spans")))
        .drop("whole", "key", "terms")
    )


def blanked(text: Column, spans: Column) -> Column:
    """The text with a blank for each character of its spans."""

    def step(state: Column, s: Column) -> Column:
        kept = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        blanks = F.repeat(F.lit(" "), s["end"] - F.greatest(s["start"], state["at"]))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], F.array(kept, blanks)).alias("out")
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"])))
    return F.aggregate(
        by_place,
        start,
        step,
        lambda state: F.concat(F.array_join(state["out"], ""), F.substring(text, state["at"] + 1, F.char_length(text))),
    )


def _without(text: Column, spans: Column) -> Column:
    """The text with its spans replaced or removed; overlapping spans go as one, by the mark of the first."""
    by_place = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"], s["action"]))
    )

    def step(state: Column, s: Column) -> Column:
        mark = F.when(s["action"] == "removed", "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        kept = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        fresh = s["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], F.array(kept, mark))).otherwise(state["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    joined = F.aggregate(
        by_place,
        start,
        step,
        lambda state: F.concat(
            F.array_join(state["out"], ""), F.substring(text, state["at"] + 1, F.char_length(text))
        ),
    )
    return F.when(F.size(spans) > 0, joined).otherwise(text)
