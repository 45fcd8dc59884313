"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again by the next.

A stage is a function of (spark, docs, sf_dir) that works on all rows its predecessor kept. All stages but the last return
rows of `documents` with their columns unchanged; the last returns the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armature.llm import decontaminate, langid, mixing, quality, simhash, textkit
from armature.sources.sinks import scratch

KEEP_QUALITY = 0.7


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: those without a letter, or with letters of no language, go.

    With no labelled language to learn from, every text is unknown and goes.
    """
    known = docs.filter(textkit.fold_number(F.col("doc_id"), 3) != 1)
    model = langid.train(known, "text", "lang", "doc_id")
    names = textkit.free_name(docs, "found_language"), textkit.free_name(docs, "found_share")
    found = langid.identify(docs, model, "text", names=names)
    return found.filter((F.col(names[0]) != langid.UNKNOWN) & (F.col(names[1]) > 0)).select(*docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of good quality is high enough. With one class of labels only, or none, the model is a
    constant and nothing is known against any document, so all stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(textkit.fold_number(F.col("doc_id"), 4) != 2)
    model = quality.train(docs, labels)
    if all(not t.any() for t in model.tables):
        return docs
    names = textkit.free_name(docs, "found_quality"), textkit.free_name(docs, "found_good")
    return quality.score(docs, model, "text", KEEP_QUALITY, names=names).filter(F.col(names[1]) == 1).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked at four or fewer bits: the one with the smallest id."""
    return simhash.keep_one(docs, shingle=4, bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: how many words of each document are taken."""
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
]

#: Trained models and 64-bit fingerprints cannot be said in SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
