"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

#: Separators of the word definitions: space and U+0009 to U+000D.
ASCII_SPACE = " \t\n\x0b\x0c\r"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: it cuts the lineage, and a
    lost executor costs no recomputation of what came before.  The shuffle files of the write
    are of no use after it, so Spark is told to remove them at its end."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{tag}-{uuid.uuid4().hex}")
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_tag() -> "F.Column":
    """Tells rows that share a doc_id apart by their text; rows equal in both are one document."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def by_text(docs: DataFrame) -> DataFrame:
    """doc_id and text with the numbers doc and tag, equal for rows equal in both; a null doc_id
    takes the least long, so that numpy can hold doc."""
    return docs.select("doc_id", F.coalesce("doc_id", F.lit(-(2**63))).alias("doc"), text_tag().alias("tag"), "text")


def mapped(df: DataFrame, batch_fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``batch_fn`` over the Arrow batches of ``df``; each call yields any number of batches."""

    def run(batches):
        for batch in batches:
            yield from batch_fn(batch)

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """UTF-8 bytes of a text column, null as empty, one value at a time."""
    for value in batch.column(batch.schema.get_field_index(name)):
        yield value.as_buffer().to_pybytes() if value.is_valid else b""


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser over an array of uint64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
