"""Reading what may not be there yet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_if_there(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The Parquet table at ``path``, or None where the path does not exist.

    Every other failure (no permission, a broken file, an unreachable store) is raised: it
    must not pass for an empty table that a load then writes over.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
