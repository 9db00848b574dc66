"""CSV lake tables, JSON records and file sinks (SRC7, SRC9, SRC10, SNK1-SNK7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.staging import staged


def all_string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_lake_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """SRC7: external CSV table, one folder per table, every column a string."""
    return spark.read.schema(all_string_schema(columns)).option("header", "false").csv(path)


def read_csv_with_header(spark: SparkSession, path: str) -> DataFrame:
    """SRC9: CSV with a header row (byte-order mark dropped by the reader).

    Column lookup in Spark is case-insensitive by default, so ``id`` and
    ``encryptedrib`` resolve whatever the letter case in the header is.
    """
    return (
        spark.read.option("header", "true")
        .option("encoding", "UTF-8")
        .option("inferSchema", "false")
        .csv(path)
    )


def read_json_records(spark: SparkSession, path: str, schema: T.StructType, ts_col: str | None = None) -> DataFrame:
    """SRC10: JSON lines with a declared schema; the time column parsed automatically."""
    df = spark.read.schema(schema).json(path)
    if ts_col is not None:
        df = df.withColumn(ts_col, F.to_timestamp(F.col(ts_col)))
    return df


def write_lake_csv(df: DataFrame, path: str) -> None:
    """Write a table the way the lake stores it: header-less CSV, all text."""
    df.select([F.col(c).cast("string").alias(c) for c in df.columns]).write.mode("overwrite").csv(path)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """SNK1."""
    df.write.mode("append").format(fmt).save(path)


def replace(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """SNK2."""
    df.write.mode("overwrite").format(fmt).save(path)


def create_empty_then_append(df: DataFrame, path: str) -> None:
    """SNK3: create the target from the schema, then append the rows in one write."""
    df.limit(0).write.mode("overwrite").parquet(path)
    df.write.mode("append").parquet(path)


def write_twice(df: DataFrame, path_a: str, path_b: str) -> tuple[int, int]:
    """SNK5: the same rows to two destinations; the second is written from the first, so the
    source is evaluated once.  Different row counts raise; they are returned as read back."""
    df.write.mode("overwrite").parquet(path_a)
    spark = df.sparkSession
    first = spark.read.schema(df.schema).parquet(path_a)
    first.write.mode("overwrite").parquet(path_b)
    counts = first.count(), spark.read.schema(df.schema).parquet(path_b).count()
    if counts[0] != counts[1]:
        raise RuntimeError(f"{path_a} has {counts[0]} rows, {path_b} has {counts[1]}")
    return counts


def export_csv_with_stamp(df: DataFrame, base: str, as_of: str) -> str:
    """SNK6: CSV export with header into a ``<base>_<yyyymmdd>`` folder."""
    stamp = as_of[:10].replace("-", "")
    path = f"{base}_{stamp}"
    df.write.mode("overwrite").option("header", "true").csv(path)
    return path


def write_time_partitioned(
    df: DataFrame, path: str, ts_col: str, part_col: str = "event_date", rows_per_file: int = 1_000_000
) -> None:
    """SNK7: store partitioned by the event date so reads prune by time.

    Rows per day are counted first: a day is written by as many tasks, into as many
    files, as its rows need, an ordinary one by one.  Rows are dealt to a day's files by
    a hash of the row.
    """
    dated = df.withColumn(part_col, F.to_date(F.col(ts_col)))
    days = staged(dated.groupBy(F.col(part_col).alias("_day")).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_files")), "day-files")
    total = days.agg(F.sum("_files")).first()[0] or 1
    dealt = dated.join(days, F.col(part_col).eqNullSafe(F.col("_day"))).withColumn(
        "_file", F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in df.columns]), F.col("_files"))
    )
    at_least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        dealt.repartition(max(at_least, total), part_col, "_file")
        .drop("_day", "_files", "_file")
        .write.mode("overwrite")
        .partitionBy(part_col)
        .parquet(path)
    )
