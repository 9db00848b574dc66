"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import scratch_path


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back.

    It cuts the lineage, so a lost executor recomputes nothing before it, and the
    optimizer knows the table's size on disk: a small one is broadcast by the size
    limit, not by a hint.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "staged", f"{tag}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
