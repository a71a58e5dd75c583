"""The registered queries: each operator on its whole table, with its production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amity.llm import centroids
from amity.llm.bpe import decode_documents, encode_documents
from amity.llm.crosspolytope import neighbours
from amity.llm.fingerprints import edited_fingerprints
from amity.llm.html import extract
from amity.llm.lines import dedupe_lines
from amity.llm.maxscore import integer_components, top_k
from amity.llm.mixing import mix
from amity.llm.periods import periodic_runs
from amity.llm.pii import KINDS, sanitise
from amity.llm.simhash import near_duplicates
from amity.llm.suffixes import remove_repeats
from amity.llm.tables import shared_table, table
from amity.llm.toxicity import fit, score_documents

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    encoded = encode_documents(docs, RANKS, public_tokenizers.PATTERN)
    return decode_documents(encoded, RANKS).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").where(~held_out())
    scored = score_documents(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op3_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.array_join("main_blocks", "\n")
    return extract(table(spark, sf_dir, "pages", "page_id", "url", "html")).select(
        "page_id", "url", text.alias("text"), F.char_length(text).cast("bigint").alias("n_chars")
    )


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise(table(spark, sf_dir, "documents", "doc_id", "text")).drop("sanitised", "text")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "term")
    return found.select(
        "doc_id",
        *map(number, KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op5_prefix_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return edited_fingerprints(docs).select(
        "doc_id",
        "n_chars",
        F.sha2("edited_text", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op6_induced_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op7_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_lines(table(spark, sf_dir, "documents", "doc_id", "text"))


#: Shares of all tokens by the quality of the labels table.
MIXTURE = {"1": 0.92, "0": 0.08}


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    return labels.select("doc_id", F.col("quality").cast("string").alias("domain"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return mix(docs, quality_labels(spark, sf_dir), MIXTURE)


def op9_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    vectors = rows.select("vec_id", integer_components(F.col("embedding")).alias("vector"))
    asked = vectors.where(F.col("vec_id") % 50 == 0)
    n = rows.count()
    return top_k(vectors, asked, n_rows=n, n_queries=-(-n // 50), k=5)


def repeated_words(words: Column, h: Column) -> Column:
    """The words as one text, where from word ``a`` on the next ``p`` follow each other again and again."""
    g = F.floor(h / 10)

    def place(ws: Column, i: Column) -> Column:
        n = F.size(ws)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")

    # The words are bound once, as the lambda's argument.
    again = F.transform(F.array(words), lambda ws: F.array_join(F.transform(ws, lambda _, i: F.get(ws, place(ws, i))), " "))
    return F.get(again, F.lit(0))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    text = F.when(h % 10 == 0, repeated_words(words, h)).otherwise(F.col("text"))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return periodic_runs(docs.withColumn("text", text)).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "longest.*",
        F.floor(F.col("longest.length") * 1000 / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: Centroids, rounds and components of the clustering.
CENTROIDS, ROUNDS, DIMS = 40, 5, 64


def op12_orchard(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    whole = vectors.select("vec_id", integer_components(F.col("embedding")).alias("vector"))
    # Every round reads the whole numbers again, so they are written once.
    rows = shared_table(centroids.usable(whole, DIMS))
    order = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    start = centroids.first_centroids(rows, CENTROIDS, order)
    found = centroids.cluster(rows, centroids.fit_centroids(rows, start, ROUNDS))
    return found.select(
        F.col("id").alias("vec_id"),
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"),
    )


def op13_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return neighbours(rows, rows.where(F.col("vec_id") % 20 == 0), k=20)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_simhash": op2_simhash,
    "op3_style_tree": op3_style_tree,
    "op4_pii": op4_pii,
    "op5_prefix_hashes": op5_prefix_hashes,
    "op6_induced_suffixes": op6_induced_suffixes,
    "op7_fuzzy_lines": op7_fuzzy_lines,
    "op8_mixing": op8_mixing,
    "op9_maxscore": op9_maxscore,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_orchard": op12_orchard,
    "op13_cross_polytope": op13_cross_polytope,
}

#: CRC-32 in SQL: the table of its polynomial by rule, then one look-up for each byte of the text.
_CRC_TABLE = "i"
for _ in range(8):
    _CRC_TABLE = f"list_transform({_CRC_TABLE}, lambda c: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
_CRC_TABLE = _CRC_TABLE.replace("(i,", "(range(256),")

def _rounds_sql() -> str:
    """``a0`` … are the assignments to the centroids ``c0`` …, ``c{i + 1}`` the means of ``a{i}``."""
    out = ""
    for i in range(ROUNDS + 1):
        if i:
            out += f"""
        c{i} AS MATERIALIZED (
            SELECT c, coalesce(mean, v) AS v FROM c{i - 1} LEFT JOIN (
                SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY d)::BIGINT[] AS mean
                FROM (SELECT c, d, sum(v[d]) AS s, count(*) AS n FROM a{i - 1}, range(1, {DIMS + 1}) t(d) GROUP BY c, d)
                GROUP BY c) USING (c)
        ),"""
        out += f"""
        a{i} AS MATERIALIZED (
            SELECT vec_id, v, found[1] AS distance, found[2] AS c
            FROM (SELECT x.vec_id, any_value(x.v) AS v, min([list_sum(
                      [(x.v[d] - y.v[d]) * (x.v[d] - y.v[d]) FOR d IN range(1, {DIMS + 1})])::BIGINT, y.c]) AS found
                  FROM vectors x, c{i} y GROUP BY x.vec_id)
        ),"""
    return out.rstrip(",")


SQL: dict[str, str] = {
    "op12_orchard": f"""
        WITH vectors AS MATERIALIZED (
            SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
            FROM embeddings
            WHERE len(embedding) = {DIMS} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v
            FROM vectors ORDER BY sha256('2:' || vec_id) LIMIT {CENTROIDS}
        ),{_rounds_sql()}
        SELECT vec_id, c::INT AS cluster, distance, sum(distance) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
               sum(distance) OVER ()::BIGINT AS inertia, sha256(list_aggregate(y.v, 'string_agg', ',')) AS centroid_sha256
        FROM a{ROUNDS} JOIN c{ROUNDS} y USING (c)
    """,
    "op11_periodic_runs": f"""
        WITH crc AS (SELECT {_CRC_TABLE} AS t),
        docs AS MATERIALIZED (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
                   xor(4294967295, list_reduce(
                       [ascii(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')],
                       lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]), 4294967295::BIGINT)) AS h
            FROM documents, crc
        ), words AS MATERIALIZED (
            SELECT doc_id, i, CASE WHEN h % 10 = 0 AND i >= a
                                   THEN w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] ELSE w[i + 1] END AS word, n
            FROM (SELECT doc_id, w, h, h // 10 AS g, len(w) AS n, (h // 10) % len(w) AS a, unnest(range(len(w))) AS i
                  FROM docs WHERE len(w) > 0)
        ), matches AS (
            SELECT x.doc_id, x.i, x.i - y.i AS q FROM words x JOIN words y
              ON x.doc_id = y.doc_id AND x.word = y.word AND y.i < x.i AND 4 * (x.i - y.i) <= x.n
        ), diagonals AS (
            SELECT doc_id, q, min(i) - q AS start, count(*) + q AS length
            FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM matches)
            GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)
        ), runs AS MATERIALIZED (
            SELECT doc_id, start, length, min(q) AS period FROM diagonals GROUP BY doc_id, start, length
        ), kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words
            WHERE (doc_id, i) NOT IN (SELECT (doc_id, unnest(range(start + period, start + length))) FROM runs)
            GROUP BY doc_id
        ), told AS (
            SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS text
            FROM runs GROUP BY doc_id
        ), longest AS (
            SELECT *, length * 1000 // period AS exponent_milli,
                   row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) AS place
            FROM runs
        )
        SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, exponent_milli,
               sha256(coalesce(told.text, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
        FROM docs d LEFT JOIN told USING (doc_id) LEFT JOIN kept USING (doc_id)
        LEFT JOIN (FROM longest WHERE place = 1) USING (doc_id)
    """,
    "op9_maxscore": """
        WITH vectors AS (
            SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), scores AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_dot_product(q.v, c.v)::BIGINT AS score
            FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
            FROM scores
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
}
