"""Structured Streaming record flows (STRM1-STRM7).

Sources are file streams (new files in a landing folder are the new or
changed rows) or a growing table read by its largest value (``max_value``).  Sinks are checkpointed, so a restarted query resumes where it
stopped, and every sink is idempotent under replay of a micro-batch:

* the Parquet file sink is exactly-once by itself (STRM1, STRM2, STRM4, STRM5);
* ``foreachBatch`` sinks write each batch into its own ``batch_id=<n>``
  partition with dynamic partition overwrite, so a replayed batch replaces
  its own rows; readers fold the log (latest row per key) - merge on read
  instead of rewriting the table every micro-batch (STRM3, STRM6, STRM7).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import dates as dt
from ..functions import protect as pr
from ..functions import text as tx
from ..session import scratch_path
from ..sources.paths import read_if_there

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for one run of a flow."""
    return scratch_path(spark, "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def file_stream(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, max_files: int | None = None) -> DataFrame:
    """New files in ``path`` are the new / changed rows (the file source tracks what it read)."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def clean_records(stream: DataFrame) -> DataFrame:
    """STRM2: stateless per-record cleaning (the same column rules as the batch loads)."""
    return stream.withColumn("event_type", tx.capitalize("event_type")).withColumn("value", tx.fill("value", 0.0))


def shape_records(stream: DataFrame, data_source: str) -> DataFrame:
    """STRM4: records as JSON text with every field kept and a default ``dataSource`` field."""
    shaped = pr.with_default_field(
        stream.select("event_id", dt.render_datetime("ts").alias("ts"), "user_id", "event_type", "value"), "dataSource", data_source
    )
    return shaped.select("event_id", pr.to_json_record(shaped).alias("record"))


def append_to_store(stream: DataFrame, path: str, checkpoint: str, partition_col: str | None = None, ts_col: str = "ts") -> StreamingQuery:
    """STRM5: continuous append into a Parquet store, partitioned by event date when asked (SNK7)."""
    out = stream
    writer_cols: list[str] = []
    if partition_col:
        out = out.withColumn(partition_col, F.to_date(F.col(ts_col)))
        writer_cols = [partition_col]
    w = out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    if writer_cols:
        w = w.partitionBy(*writer_cols)
    return w.trigger(availableNow=True).start()


def _write_batch_partition(df: DataFrame, path: str, batch_id: int) -> None:
    """Idempotent batch write: the rows of one micro-batch replace partition ``batch_id=<n>``."""
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def upsert_stream(stream: DataFrame, key: str, value_cols: Sequence[str], order_cols: Sequence[str], log_path: str, checkpoint: str) -> StreamingQuery:
    """STRM3: continuous upsert.  Each batch keeps the last version per key, then logs it."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        # last version per key and first-seen time in one aggregate (map-side combine,
        # so a key with many versions in the batch does not land whole in one task)
        order = F.struct(*[F.col(c) for c in order_cols])
        last = batch.groupBy(key).agg(
            F.max_by(F.struct(*[F.col(c) for c in [*value_cols, *order_cols]]), order).alias("_last"),
            F.min(order_cols[0]).alias("_first_seen"),
        )
        rows = last.select(key, *[F.col(f"_last.{c}").alias(c) for c in [*value_cols, *order_cols]], "_first_seen")
        _write_batch_partition(rows, log_path, batch_id)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _compacted_path(log_path: str) -> str:
    return f"{log_path.rstrip('/')}_compacted"


def _effective_log(spark: SparkSession, log_path: str, last: int | None = None) -> DataFrame:
    """The log as readers see it: the last compaction (if any) plus the batches after it, up to ``last``.

    Batches already folded into the compaction are skipped by partition pruning,
    so reading cost does not grow with the length of the stream.
    """
    log = spark.read.parquet(log_path)
    if last is not None:
        log = log.filter(F.col("batch_id") <= F.lit(last))
    done = read_if_there(spark, f"{_compacted_path(log_path)}/done")
    upto = None if done is None else done.agg(F.max("upto")).first()[0]
    if upto is None:
        return log
    compacted = spark.read.parquet(f"{_compacted_path(log_path)}/upto_{upto}")
    return compacted.unionByName(log.filter(F.col("batch_id") > F.lit(upto)))


def _compact(spark: SparkSession, log_path: str, fold) -> None:
    """Fold the log up to the last batch there is now.

    The bound is taken first and the fold reads no later batch, so one that lands
    meanwhile stays in the log.  Each compaction has a folder of its own, which
    readers use once its row in ``done`` is there.
    """
    upto = spark.read.parquet(log_path).agg(F.max("batch_id")).first()[0]
    if upto is None:
        return
    folded = fold(_effective_log(spark, log_path, upto)).withColumn("batch_id", F.lit(upto).cast("long"))
    folded.write.mode("overwrite").parquet(f"{_compacted_path(log_path)}/upto_{upto}")
    spark.createDataFrame([(upto,)], "upto long").write.mode("append").parquet(f"{_compacted_path(log_path)}/done")


def _upsert_fold(log: DataFrame, key: str, value_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    order = F.struct(*[F.col(c) for c in order_cols], F.col("batch_id"))
    return log.groupBy(key).agg(
        *[F.max_by(F.col(c), order).alias(c) for c in [*value_cols, *order_cols]],
        F.min("_first_seen").alias("_first_seen"),
        F.max("batch_id").alias("batch_id"),
    )


def read_upserted(spark: SparkSession, log_path: str, key: str, value_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Current table of an upsert log: the latest row per key, first-seen and last-update times."""
    folded = _upsert_fold(_effective_log(spark, log_path), key, value_cols, order_cols)
    return folded.select(
        key, *value_cols, F.col("_first_seen").alias("dw_insert_date"), F.col(order_cols[0]).alias("dw_update_date")
    )


def compact_upsert_log(spark: SparkSession, log_path: str, key: str, value_cols: Sequence[str], order_cols: Sequence[str]) -> None:
    """Fold the upsert log into one row per key."""
    _compact(spark, log_path, lambda log: _upsert_fold(log, key, value_cols, order_cols))


def _mark_before(spark: SparkSession, marks_path: str, batch_id: int):
    """The latest event time of the batches before this one, or None."""
    marks = read_if_there(spark, marks_path)
    return None if marks is None else marks.filter(F.col("batch_id") < F.lit(batch_id)).agg(F.max("seen")).first()[0]


def windowed_stream(
    stream: DataFrame, ts_col: str, dims: Sequence[str], aggs: dict[str, F.Column], log_path: str, checkpoint: str, delay: str = "1 hour",
) -> StreamingQuery:
    """Event-time groups per day and ``dims``, late rows kept apart.

    The watermark of a batch is the latest event time of the batches before it less
    ``delay``.  A row whose day had ended by then is late: it goes to ``<log>_late`` as it
    is, and is in no group.  Of the others each batch logs its own partial aggregates
    (``aggs``: sums, counts, minima, maxima), which the reader folds.  So there is no
    operator state to expire: what is kept is a row per batch and group, which
    ``compact_partials`` folds, and a row per batch for the watermark.  A replayed batch
    sees the same earlier marks and replaces its own partitions.
    """
    marks_path, late_path = f"{log_path}_marks", f"{log_path}_late"

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _mark_before(spark, marks_path, batch_id)
        day = F.to_date(F.col(ts_col))
        ended = F.lit(False)
        if before is not None:
            watermark = F.lit(before).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")
            ended = F.coalesce((day + F.expr("INTERVAL 1 DAY")).cast("timestamp_ntz") <= watermark, F.lit(False))
        batch.persist()
        try:
            groups = batch.filter(~ended).groupBy(day.alias("day"), *dims).agg(*[a.alias(n) for n, a in aggs.items()])
            _write_batch_partition(groups, log_path, batch_id)
            if before is not None:
                _write_batch_partition(batch.filter(ended), late_path, batch_id)
            _write_batch_partition(batch.agg(F.max(ts_col).alias("seen")), marks_path, batch_id)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_partials(spark: SparkSession, log_path: str, group_cols: Sequence[str], folds: dict[str, str]) -> DataFrame:
    """Fold a log of partial aggregates; ``folds`` names sum, min or max per column."""
    return _fold_partials(_effective_log(spark, log_path), group_cols, folds)


def _fold_partials(log: DataFrame, group_cols: Sequence[str], folds: dict[str, str]) -> DataFrame:
    return log.groupBy(*group_cols).agg(*[getattr(F, how)(c).cast(log.schema[c].dataType).alias(c) for c, how in folds.items()])


def compact_partials(spark: SparkSession, log_path: str, group_cols: Sequence[str], folds: dict[str, str]) -> None:
    """Fold a log of partial aggregates into one row per group."""
    _compact(spark, log_path, lambda log: _fold_partials(log, group_cols, folds))


def read_late(spark: SparkSession, log_path: str, schema: T.StructType) -> DataFrame:
    """The late rows of a log, none if there were none (its batches then left an empty folder, or none)."""
    late = read_if_there(spark, f"{log_path}_late", schema)
    return spark.createDataFrame([], schema) if late is None else late


def rollup_stream(
    stream: DataFrame, ts_col: str, dims: Sequence[str], metric: str, log_path: str, checkpoint: str, delay: str = "1 hour",
) -> StreamingQuery:
    """STRM6: metric summed per day and dimensions; late rows go to the side output (``read_late``)."""
    aggs = {metric: F.sum(F.col(metric).cast("decimal(18,2)")).cast("decimal(28,2)"), "rows": F.count(F.lit(1))}
    return windowed_stream(stream, ts_col, dims, aggs, log_path, checkpoint, delay)


def read_rollup(spark: SparkSession, log_path: str, dims: Sequence[str], metric: str) -> DataFrame:
    """STRM6: the rollup as it is now."""
    folded = read_partials(spark, log_path, ["day", *dims], {metric: "sum", "rows": "sum"})
    return folded.withColumn(metric, F.col(metric).cast("double"))


def read_latest_groups(spark: SparkSession, log_path: str, group_cols: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """Fold an update-mode log: per group the values from the newest batch."""
    log = _effective_log(spark, log_path)
    return log.groupBy(*group_cols).agg(*[F.max_by(F.col(c), F.col("batch_id")).alias(c) for c in value_cols])


def compact_group_log(spark: SparkSession, log_path: str, group_cols: Sequence[str], value_cols: Sequence[str]) -> None:
    """Fold an update-mode log into one row per group."""
    newest = [F.max_by(F.col(c), F.col("batch_id")).alias(c) for c in value_cols]
    _compact(spark, log_path, lambda log: log.groupBy(*group_cols).agg(*newest))


def first_insert_stream(
    stream: DataFrame, table_col: str, ts_col: str, log_path: str, checkpoint: str, delay: str = "1 hour",
) -> StreamingQuery:
    """STRM7: first insert per table and day; rows of days that ended before the watermark go to the side output."""
    named = stream.withColumn("table_name", F.col(table_col))
    return windowed_stream(named, ts_col, ["table_name"], {"first_insert": F.min(ts_col)}, log_path, checkpoint, delay)


def read_first_inserts(spark: SparkSession, log_path: str) -> DataFrame:
    """STRM7: the first inserts as they are now."""
    return read_partials(spark, log_path, ["table_name", "day"], {"first_insert": "min"})


def await_done(q: StreamingQuery, timeout_s: int = 600) -> None:
    finished = q.awaitTermination(timeout_s)
    if not finished:
        q.stop()
        raise TimeoutError(f"stream {q.name or q.id} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
