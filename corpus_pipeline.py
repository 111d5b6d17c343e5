"""The corpus pipeline: language ID, exact dedup, near dedup, decontamination, packing.

Each stage is a function of (spark, docs, sf_dir). ``run`` writes every stage's rows as Parquet
under the shared work folder and reads them back as the next stage's documents. All stages but the
last return the columns of ``documents``, extra ones included whatever their names; the last returns
one row per packed piece.

Defined cases: a null or empty text, or one without a letter, goes at the first stage, as do all
documents if no row is labelled with a language. Of rows with equal texts the one with the smallest
doc_id stays, a null one only if there is no other; rows that repeat id and text are one. A document
of fewer than five words is near to none but its equals, which are gone by then. Without benchmark
items nothing is contaminated. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import staged, table
from tessera.llm.decontamination import drop_contaminated
from tessera.llm.exact_dedup import drop_duplicates_exact
from tessera.llm.language_id import drop_unidentified
from tessera.llm.ngram_join import keep_one_per_group
from tessera.llm.packing import pack


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose language cannot be told (no letter), or is told with a score below
    ``language_id.MIN_SCORE``."""
    return drop_unidentified(spark, docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    return drop_duplicates_exact(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) one document stays."""
    return keep_one_per_group(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return drop_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents, tokenised and packed into windows."""
    return pack(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: Language ID, near dedup and packing cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
