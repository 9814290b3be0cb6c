"""The training-data pipeline: documents in, token ids out, stage by stage."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlens.llm import bpe, decontaminate, pii, quality, simhash
from matchlens.session import work_folder


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality rules reject."""
    return docs.filter(quality.kept(quality.references(docs), "text", "lang"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: fingerprints of 3-word shingles within 3 bits."""
    return simhash.first_of_each(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark passage."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data inside the texts, and count their characters anew."""
    return docs.withColumn("text", pii.redact("text")).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of what they decode to."""
    return bpe.round_trip(docs, with_ids=True)


STAGES = [
    ("quality rules", good_documents),
    ("near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmarks),
    ("PII", without_personal_data),
    ("BPE encoding and decoding", tokens),
]

#: Distances to learned references, fingerprints and encodings are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each one reading what the one before has written."""
    folder = f"{work_folder(spark)}/pipeline-{uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        if at == len(STAGES) - 1:
            return made
        made.write.parquet(f"{folder}/{at}")
        docs = spark.read.parquet(f"{folder}/{at}")
    raise ValueError("STAGES is empty")
