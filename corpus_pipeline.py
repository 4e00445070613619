"""A training-data pipeline over ``documents``: the stages, and the whole run.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillflow.llm import minhash, packing, pii, quality, rules
from tillflow.llm.runtime import scratch_table

#: SQL has no text features, sketches, tokenizer or packing; the stages are tested against brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bradley-Terry quality scores; documents below the cut go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, quality.not_held_out())
    return quality.keep_documents(docs, model)


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Base rules and cross-document line frequency; boilerplate lines and rejected documents go."""
    return rules.apply_rules(docs)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near duplicates (5-word shingles, similarity 0.8 or more); the smallest doc_id of each group stays."""
    return minhash.drop_near_duplicates(docs, minhash.NearDup(words=5))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that reveal it are replaced; no document goes.

    Near copies have been taken out by the stage before, so documents are counted as they are.
    """
    return pii.sanitise(docs, pii.Disclosure(merge_copies=False))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit-decreasing packing into sequences of 4096 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("quality rules", rules_stage),
    ("MinHash near-dedup", near_dup_stage),
    ("PII", pii_stage),
    ("best-fit packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
