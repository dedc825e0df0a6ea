"""A corpus pipeline: quality rules, exact and near duplicates, mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; all but the last return the columns of ``documents``. Nulls, empty texts,
repeated rows and extra columns are handled as each operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from auditlens.llm.common import materialise
from auditlens.llm.exact_dedup import drop_exact_duplicates
from auditlens.llm.mixing import mixed_documents
from auditlens.llm.near_dedup import drop_near_duplicates
from auditlens.llm.packing import pack
from auditlens.llm.quality import drop_low_quality

#: Similarity from which the stage of near duplicates links two texts; op4 has its own.
NEAR_PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; frequent lines leave the texts of the others."""
    return drop_low_quality(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    return drop_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays; links from NEAR_PERCENT on."""
    return drop_near_duplicates(docs, percent=NEAR_PERCENT)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per packed piece."""
    return pack(docs)


STAGES = [("quality rules", quality_stage), ("exact dedup", exact_stage), ("MinHash near-dedup", near_stage),
          ("mixing to target weights", mix_stage), ("best-fit packing", pack_stage)]

#: Packing is a greedy procedure and the filter of near duplicates a search;
#: SQL expresses neither. tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
