"""The corpus pipeline: its stages over ``documents``, each written before the next one reads it.

The quality classifier's rejects go, then all but one of equal texts, then all but one of each
group of near copies; secrets are struck out of what is left, and it is packed into sequences.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import exact_dedup, jaccard_join, packing, quality_classifier, secret_scan
from martloom.session import scratch_folder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
END_OF_DOCUMENT = 0
#: Near copies have four fifths of their shingles of five words in common.
NEAR_WORDS, NEAR_SHARE = 5, (80, 100)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, trained on ``labels``, doesn't reject."""
    labels = quality_classifier.read_labels(spark, sf_dir)
    return quality_classifier.keep_good(docs, quality_classifier.fit(docs, labels))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, the longest as written; texts are compared without white space."""
    return exact_dedup.keep_first(docs, exact_dedup.new_index(docs))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of the Jaccard join lead to, the one with the smallest id."""
    return jaccard_join.keep_one_of_each(docs, share=NEAR_SHARE, n_words=NEAR_WORDS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark; ``n_chars`` follows the text."""
    clean = secret_scan.redact_documents(docs)
    if "n_chars" not in docs.columns:
        return clean
    length = F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", length).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, in sequences of at most 1024 ids."""
    return packing.pack_documents(docs, BYTE_BPE, END_OF_DOCUMENT)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("secret scans", secrets),
    ("packing", packed),
]

#: The classifier, the secret battery's logarithms and the packing have no counterpart in SQL;
#: the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{scratch_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
