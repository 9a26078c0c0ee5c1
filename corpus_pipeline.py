"""Corpus pipeline: documents to packed training sequences, in five stages.

Every stage is written as Parquet in the shared folder and read again, so a lost
executor repeats part of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.llm import decontamination, near_dedup, packing, pii, quality
from strandwise.llm.common import materialize, stand_ins, where_computed, without_stand_ins
from strandwise.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; those tagged with other languages are not judged by function words."""
    return where_computed(quality.quality(docs, lang="lang"), "kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each class stays. A row without one is a document of its own, which any doc_id precedes."""
    docs, first = stand_ins(docs)
    kept = near_dedup.near_duplicates(docs).where("doc_id = class_id").select("doc_id").distinct()
    return without_stand_ins(docs.join(kept, "doc_id", "left_semi").select(*COLUMNS), first)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; a row without doc_id is a document of its own."""
    docs, first = stand_ins(docs)
    found = decontamination.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without_stand_ins(docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*COLUMNS), first)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found spans are replaced by their kind."""
    return pii.redact(docs, pii.fit(docs)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("personal data", personal_data),
    ("packing", pack),
]

#: Signatures, alignment, trees and tokenizer have no SQL form; a test runs the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
