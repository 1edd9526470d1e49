"""The training-data pipeline over the table `documents`: five stages, each an operator's decision.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps, with their columns;
the last returns pieces of token sequences. Stages are written and read between each other.
Nulls, empty texts, repeated rows and empty tables are as the operators define them; columns
beyond those of `documents` are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.llm.decontaminate import without_benchmark
from storeledger.llm.jaccard_join import jaccard_join
from storeledger.llm.language import UNDETERMINED, identify_language, train_language_model
from storeledger.llm.packing import pack
from storeledger.llm.secrets import find_secrets, labelled_findings, redact, train_forest
from storeledger.llm.support import Scratch, crc_remainder

# A language less likely than this is no language.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; the others go, as do texts without a letter.

    The model learns from documents that are not held out; `lang` of a kept document stays as it was.
    """
    model = train_language_model(docs.filter(crc_remainder("doc_id", 4) != 2))
    # The other columns go along as one, so that none clashes with the operator's.
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    known = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    rows = identify_language(docs.select("text", others.alias("others")), model).filter(known)
    return rows.select(*[F.col("text" if c == "text" else f"others.`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts the document of the least id; of rows with equal id and text, one.

    Different texts under one id are documents of their own. Documents without an id, or without words,
    are in no group and stay.
    """
    named, scratch = docs.filter("doc_id is not null"), Scratch(spark, "pipeline")
    digest = F.xxhash64("text")
    texts = named.groupBy("doc_id").agg(F.min(digest).alias("low"), F.max(digest).alias("high"))
    key = "doc_id"
    if not texts.filter("low < high").isEmpty():  # then ids do not tell texts apart
        while key in docs.columns:
            key += "_"
        named = named.withColumn(key, F.xxhash64("doc_id", "text"))
    groups = jaccard_join(named.select(F.col(key).alias("doc_id"), "text"), scratch)
    if key == "doc_id":
        kept = groups.filter("doc_id = component_id").select("doc_id").distinct()
    else:
        ids = named.select(F.col(key).alias("named"), F.col("doc_id").alias("id")).distinct()
        members = groups.select(F.col("doc_id").alias("named"), "component_id").distinct().join(ids, "named")
        first = members.groupBy("component_id").agg(F.min(F.struct("id", "named")).alias("first"))
        kept = first.select(F.col("first.named").alias(key))
    rows = named.join(kept, key, "left_semi").dropDuplicates([key]).select(*docs.columns)
    return rows.unionByName(docs.filter("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold half of a benchmark item."""
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    return redact(docs, find_secrets(docs, train_forest(labelled_findings(docs))))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: Language, similarity of sets of any size, tiling, a forest and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that the stages keep."""
    scratch = Scratch(spark, "pipeline")
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        rows = scratch.write(stage(spark, rows, sf_dir), name)
    return STAGES[-1][1](spark, rows, sf_dir)
