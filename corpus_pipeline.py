"""The training-text pipeline: documents in, packed token sequences out.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.llm.common import stage, table
from lapse.llm.decontamination import clean
from lapse.llm.near_dedup import one_of_each
from lapse.llm.packing import VOCABULARY, pack
from lapse.llm.paragraph_dedup import SHARE, repeated_passages, without
from lapse.llm.quality import accepted


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (similarity 0.8 or more,
    as in all stages on word shingles) stays."""
    return one_of_each(docs, SHARE)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat an earlier one are cut out of the texts."""
    out = without(docs, repeated_passages(docs))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two length."""
    return pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("decontamination", decontamination), ("packing", packing)]
#: SQL cannot express the classifier; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
