"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bagminhash, brown_lm, cotrain, decontam, line_dedup, merkle, mixing, poly_dedup, radix_windows, secret_scan, sentence_spans, spelling, templates
from .common import documents, written
from .sql import SQL  # noqa: F401


def op1_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.drop_spans(documents(spark, sf_dir), min_sentences=2, min_words=20)


def op2_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.class_of_documents(documents(spark, sf_dir), width=5, threshold=0.8)


def op3_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.score(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digests(documents(spark, sf_dir), min_docs=10, keep_first=False)


def op5_radix_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix_windows.window_digests(documents(spark, sf_dir), length=200)


def op6_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.score(documents(spark, sf_dir), folds=10)


def op7_poly_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poly_dedup.exact_groups(documents(spark, sf_dir))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = documents(spark, sf_dir).select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    mixed = mixing.mix_sources(written(sized, "words"), size=F.col("size"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.hit_digests(spark, documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op10_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.extract(documents(spark, sf_dir, "pages"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digests(documents(spark, sf_dir))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(documents(spark, sf_dir))


QUERIES = {
    "op1_sentence_spans": op1_sentence_spans,
    "op2_bagminhash": op2_bagminhash,
    "op3_cotraining": op3_cotraining,
    "op4_line_dedup": op4_line_dedup,
    "op5_radix_windows": op5_radix_windows,
    "op6_brown_lm": op6_brown_lm,
    "op7_poly_dedup": op7_poly_dedup,
    "op8_mix_sources": op8_mix_sources,
    "op9_decontaminate": op9_decontaminate,
    "op10_site_templates": op10_site_templates,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_secret_scan": op12_secret_scan,
    "op13_merkle_manifest": op13_merkle_manifest,
}
