"""A training corpus from raw documents: five stages, each writing a table that the next one reads.

Every stage takes (spark, docs, sf_dir) and returns what it keeps of ``docs`` in its columns; the last one returns
the token pieces and their sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm.language import keep_identified, train
from tillroll.llm.mixing import mix
from tillroll.llm.neardup import drop_near_duplicates
from tillroll.llm.packing import pack_documents
from tillroll.llm.secrets import redact
from tillroll.llm.tables import table
from tillroll.scratch import materialise


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents whose text is in no known language go."""
    return keep_identified(docs, train(docs))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: one document of each group of near duplicates stays."""
    return drop_near_duplicates(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: secrets that look live are replaced by a mark, copied examples are not; all documents stay."""
    return redact(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents as often as the mix takes them; those it does not take go."""
    return mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: the documents' token pieces in sequences."""
    return pack_documents(docs)


STAGES = [
    ("language", known_language),
    ("near_duplicates", without_near_duplicates),
    ("secrets", without_secrets),
    ("mixing", mixed_sources),
    ("packing", packed),
]

# Signatures, trained models and tokens cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
