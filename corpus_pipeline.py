"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

1. quality: documents that the co-trained classifier rejects go.
2. lines: lines whose key is found in ten documents or more lose all but their first place.
3. near_duplicates: one document of each class of near-duplicates stays.
4. decontamination: runs of ten benchmark words go; documents mostly made of them go as a whole.
5. mixing: every document is emitted as often as its source's rate says; copy numbers the copies.

The stages but the last return the columns of ``documents``; n_chars follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bagminhash, cotrain, decontam, line_dedup, mixing
from strata.llm.common import documents, written


def _measured(docs: DataFrame) -> DataFrame:
    """n_chars of the text as it now is, where the table has that column."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cotrain.keep_good(docs, documents(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(line_dedup.drop_lines(docs, min_docs=10, keep_first=True))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bagminhash.keep_one_per_class(docs, width=5, threshold=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(decontam.decontaminate(spark, docs, documents(spark, sf_dir, "benchmark"), window=10, max_coverage=0.5))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit_copies(mixing.mix_sources(docs))


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
]
#: No SQL expresses the classifier and the signatures; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
