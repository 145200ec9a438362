"""Corpus pipeline: five stages over ``documents``, each one operator of ``llm``.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept.  All stages but the last return the columns of ``documents``;
the last returns the packing plan.  ``run`` writes each stage's result to the
checkpoint folder and reads it again, so a lost executor repeats one stage at most.

There is no oracle SQL: clustering, hash draws and packing have no SQL form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm import op3_mixing, op4_language, op5_packing, op7_neardup, op10_substrings
from llm.common import materialize

ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose language is rejected."""
    model = op4_language.fit(docs.filter(~op4_language.held_out()))
    return op4_language.predict(docs, model).filter("NOT rejected").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group, by shingles of five words."""
    return op7_neardup.drop_near_duplicates(docs, width=5)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that an earlier document has; n_chars follows the new text."""
    return op10_substrings.dedup_documents(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample documents to the raked source, language and topic weights."""
    rows = materialize(op3_mixing.add_tokens_and_topic(docs), "mixing")
    return op3_mixing.mix(rows).filter("chosen").select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into training sequences."""
    return op5_packing.pack(op5_packing.items_of(docs))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the packing plan of the cleaned corpus."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
