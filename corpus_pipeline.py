"""A training corpus from raw documents: quality, near-duplicates, benchmark leaks, personal data, tokens.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before kept.  The first three
drop rows, the fourth replaces personal data in ``text`` by its kind, and the last turns texts into
token ids.  All but the last return the columns of ``documents``.  Null or empty texts, repeated rows and empty
tables are treated as each operator states.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm import bpe, decontam, minhash, pii, quality
from cartwheel.llm.common import stored, table
from cartwheel.llm.queries import TOKENIZER


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the positive-unlabelled classifier accepts; it learns from ``labels``."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest ``doc_id``, of each group of near-duplicates."""
    return minhash.keep_one(docs, 85)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that overlap no item of ``benchmark``."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same rows with every span of personal data replaced by its kind in brackets."""
    return pii.redact(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, token ids, their number, and digests of the ids and of the text decoded from them."""
    return bpe.round_trip(docs, public_tokenizers.path(TOKENIZER), keep_ids=True)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("tokens", token_stage),
]

#: SQL cannot express the trained stages; tests/llm holds every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
