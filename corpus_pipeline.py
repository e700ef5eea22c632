"""From raw documents to packed training sequences, in five stages over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import exact_dedup, langid, near_dedup, packing, secret_scan
from skyledger.llm.common import text_key
from skyledger.storage import staged


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected. A missing ``lang`` becomes the predicted one.

    A document with letters whose ``lang`` no model knows, since all its labelled documents are held out, is judged by nobody and stays.
    """
    who = langid.train(docs)
    unknown = F.col("lang").isNotNull() & ~F.col("lang").isin(who.names) & (F.col("lang_pred") != "und")
    found = langid.identify(docs, who).where(~F.col("rejected") | unknown)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text (A-Z in either case): the one with the largest id."""
    return exact_dedup.exact_dedup(docs).where("kept").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, at five words and similarity 0.8: the one with the smallest id."""
    kept = near_dedup.near_dedup(docs, k=5, percent=80).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    return docs.join(kept, docs["doc_id"].eqNullSafe(F.col("_id")) & (text_key(docs["text"]) == F.col("_key")), "left_semi")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the spans of secrets replaced in their texts."""
    found = secret_scan.scan(docs)
    hit = F.size("spans") > 0
    return found.withColumn("text", F.when(hit, secret_scan.redacted(F.col("text"), F.col("spans"))).otherwise(F.col("text"))).withColumn(
        "n_chars", F.when(hit, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    return packing.pack(packing.with_tokens(docs.select("doc_id", "text")).drop("text"), "tokens", "doc_id", packing.LENGTHS, packing.COSTS)


STAGES = [
    ("language_id", keep_known_languages),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: Language models and near-duplicate components have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
