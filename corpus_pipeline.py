"""From raw documents to packed training sequences, in five stages.

Each stage reads what the one before it wrote and acts on all of it: documents that fail
the quality rules go; one document of each near-duplicate group stays (five-word shingles,
similarity 0.8); documents contaminated with benchmark passages go; secrets are masked;
what is left is packed into sequences of 4096 tokens.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondage.llm import decontamination, near_dedup, packing, quality_rules, secret_scan
from sondage.llm.queries import table, tokenizer_path
from sondage.session import shared_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return quality_rules.keep_good(docs).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one of smallest id."""
    return near_dedup.keep_one(docs).select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than one word in twenty inside benchmark windows, unchanged."""
    return decontamination.remove_documents(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and n_chars counted anew where that changed the text."""
    masked = secret_scan.mask_secrets(docs.withColumn("_before", F.col("text")))
    count = F.when(F.col("text") == F.col("_before"), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))
    return masked.withColumn("n_chars", count).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences, with their token ids."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: Compression ratios, minimum hashes and token ids have no SQL form; the tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
