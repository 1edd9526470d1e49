"""Registered queries of the training-data operators, over whole tables, with DuckDB SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from storeledger.llm.attention import encoded_texts, score_texts, train_scorer
from storeledger.llm.decontaminate import contamination
from storeledger.llm.fingerprints import likeness_under_edits
from storeledger.llm.hard_negatives import hard_negatives
from storeledger.llm.jaccard_join import jaccard_join
from storeledger.llm.language import identify_language, train_language_model
from storeledger.llm.license_scan import COVERAGE, DRIFT, NOTICE, PHRASE, TEMPLATES, license_scan
from storeledger.llm.packing import pack
from storeledger.llm.periodic_runs import periodic_runs
from storeledger.llm.quality import score_quality, train_quality_model
from storeledger.llm.secrets import find_secrets, labelled_findings, train_forest
from storeledger.llm.suffix_dedup import repeated_passages
from storeledger.llm.support import Scratch, crc_remainder, documents
from storeledger.llm.warc import read_archives, write_archives


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(documents(spark, sf_dir, "doc_id", "text"), benchmark)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir, "doc_id", "text"), Scratch(spark, "op2"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return likeness_under_edits(documents(spark, sf_dir, "doc_id", "text"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text").withColumn("held_out", crc_remainder("doc_id", 3) == 1)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(crc_remainder("doc_id", 3) != 1)
    return score_quality(docs, train_quality_model(docs, labels)).drop("text")


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text").withColumn("held_out", crc_remainder("doc_id", 5) == 1)
    scratch = Scratch(spark, "op5")
    docs = encoded_texts(docs.select("doc_id", "held_out", "text"), scratch)
    model = train_scorer(docs.filter(~F.col("held_out")), scratch)
    return score_texts(docs, model).drop("text")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(documents(spark, sf_dir, "doc_id", "text"), Scratch(spark, "op6"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(documents(spark, sf_dir, "doc_id", "text"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang").withColumn("held_out", crc_remainder("doc_id", 4) == 2)
    model = train_language_model(docs.filter(~F.col("held_out")))
    return identify_language(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return find_secrets(docs, train_forest(labelled_findings(docs)))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op10")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    archives = write_archives(pages, f"{scratch.folder}/warc", scratch)
    found = read_archives(archives, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END")
    vectors = rows.select("vec_id", label.alias("label"), "embedding")
    return hard_negatives(vectors, vectors.filter("vec_id % 100 = 0"), Scratch(spark, "op11"))


_OP11_SQL = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
           CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
ranked AS (
    SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank
    FROM positives JOIN scores USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir, "doc_id", "text"))


_PLACES_SQL = ", ".join(
    f"({i}, '{t.label}', {str(t.base).lower()}, {len(t.words)}, {at}, '{' '.join(words)}')"
    for i, t in enumerate(TEMPLATES)
    for at, words in t.places()
)


def _held_sql(k: int) -> str:
    return f"bit_count({' | '.join(f'(votes << {i})' for i in range(k))})"


_OP12_SQL = f"""
WITH places(template, label, base, size, place, gram) AS (VALUES {_PLACES_SQL}),
texts AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
    FROM documents),
spread AS (SELECT r, unnest(words) AS w0, generate_subscripts(words, 1) - 1 AS word FROM texts),
shifted AS (
    SELECT r, word, w0, {", ".join(f"lead(w0, {i}) OVER (PARTITION BY r ORDER BY word) AS w{i}" for i in range(1, NOTICE))}
    FROM spread),
grams AS (
    SELECT r, word, {" || ' ' || ".join(f"w{i}" for i in range(PHRASE))} AS gram FROM shifted
    UNION ALL SELECT r, word, {" || ' ' || ".join(f"w{i}" for i in range(NOTICE))} FROM shifted),
diagonals AS (
    SELECT r, template, label, base, size, word - place AS diagonal, bit_or(CAST(1 AS BIGINT) << place) AS votes,
           min(word) AS start
    FROM grams JOIN places USING (gram) GROUP BY ALL),
apart AS (
    SELECT *, CASE WHEN diagonal - lag(diagonal) OVER along <= CASE WHEN base THEN 0 ELSE {DRIFT} END THEN 0 ELSE 1 END AS new
    FROM diagonals WINDOW along AS (PARTITION BY r, template ORDER BY diagonal)),
spans AS (
    SELECT *, sum(new) OVER (PARTITION BY r, template ORDER BY diagonal) AS span FROM apart),
merged AS (
    SELECT r, label, base, size, bit_or(votes) AS votes, min(start) AS start
    FROM spans GROUP BY r, template, label, base, size, span),
held AS (
    SELECT *, CASE WHEN base THEN {_held_sql(PHRASE)} ELSE {_held_sql(NOTICE)} END / CAST(size AS DOUBLE) AS coverage
    FROM merged),
found AS (SELECT * FROM held WHERE coverage >= CASE WHEN base THEN 1 ELSE {COVERAGE} END)
SELECT doc_id, CAST(len(any_value(words)) AS BIGINT) AS n_words, count(*) FILTER (WHERE base) AS n_base,
       min(start) FILTER (WHERE base) AS first_word, max(start) FILTER (WHERE base) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(coverage), 0.0) AS score
FROM texts LEFT JOIN found USING (r) GROUP BY r, doc_id
"""


def plant_periods(docs: DataFrame) -> DataFrame:
    """The texts of one id in ten, by its crc32, from some word on as a few words over and over; others as they are."""
    hashed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.withColumn("g", F.floor(hashed / 10)).withColumn("words", F.when(hashed % 10 == 0, words))
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    period = F.expr("CAST(1 + (n - a) DIV (3 + g % 8) AS INT)")
    tail = F.transform(F.sequence("a", F.col("n") - 1), lambda i: F.col("words")[F.col("a") + (i - F.col("a")) % F.col("p")])
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    text = F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text"))
    return rows.withColumn("p", period).select("doc_id", text.alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(plant_periods(documents(spark, sf_dir, "doc_id", "text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best["run"]).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )


# SHA-1 in base32: eight groups of five hex digits, each four letters.
_OP10_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
hashed AS (
    SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hex,
           min(page_id) OVER (PARTITION BY html) AS first
    FROM payloads)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
           ((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS INT)) & 31)
           + 1 AS INT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM hashed
"""


#: name: (query, SQL or None)
QUERIES = {
    "op1_decontamination": (op1_decontamination, None),
    "op2_jaccard_join": (op2_jaccard_join, None),
    "op3_fingerprints": (op3_fingerprints, None),
    "op4_quality": (op4_quality, None),
    "op5_lm_score": (op5_lm_score, None),
    "op6_suffix_dedup": (op6_suffix_dedup, None),
    "op7_packing": (op7_packing, None),
    "op8_language_id": (op8_language_id, None),
    "op9_secrets": (op9_secrets, None),
    "op10_warc": (op10_warc, _OP10_SQL),
    "op11_hard_negatives": (op11_hard_negatives, _OP11_SQL),
    "op12_license_scan": (op12_license_scan, _OP12_SQL),
    "op13_periodic_runs": (op13_periodic_runs, None),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
