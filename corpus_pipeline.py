"""A training-data pipeline: four operators, one after the other, over `documents`.

Each stage takes what its predecessor kept, as a table read from Parquet. The first three
return the columns of `documents`; the last returns the pieces of the packed sequences.

Defined results: null, empty and blank texts are rejected by the first stage. Rows that repeat
an id and a text leave one; those with an id and different texts are different documents, and a null id is
an id like others. Texts of equal words are near-duplicates. Extra columns stay up to the last stage,
whatever their names. No documents give no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folio.llm import near_dedup, packing, quality, substring_dedup
from folio.llm.queries import tokenizer_path
from folio.llm.shared import stored

#: SQL can't express a trained classifier, so tests hold run() against a brute-force version.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8 or more) stays."""
    return near_dedup.keep_one(docs)


def substring_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in passages of 35 words or more that recur go; the documents stay."""
    return substring_dedup.rewrite(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most 1024 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_removal),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
