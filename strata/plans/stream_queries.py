"""Registered streaming flows: each runs a checkpointed stream to completion
(``availableNow``) over the events file and returns the sink read back.

The batch oracle of each flow is the same computation as a batch query, so
the stream result must equal it (SURVEY 5, streaming layer).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import Tables
from ..streaming import flows as fl

#: Event times at which a delivery ends.
DELIVERY_CUTS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
SOURCE_GLOB = "events.parquet"


def _events_stream(spark: SparkSession, d: str) -> DataFrame:
    return fl.file_stream(spark, d, fl.EVENT_SCHEMA, glob=SOURCE_GLOB)


def strm5_append_store(spark: SparkSession, d: str) -> DataFrame:
    """STRM1 + STRM2 + STRM5: new rows cleaned in flight and appended, partitioned by event date."""
    base = fl.run_dir(spark, "store")
    q = fl.append_to_store(fl.clean_records(_events_stream(spark, d)), f"{base}/data", f"{base}/_checkpoint", partition_col="event_date")
    fl.await_done(q)
    return spark.read.parquet(f"{base}/data").drop("event_date")


def strm4_shaping(spark: SparkSession, d: str) -> DataFrame:
    """STRM4: records shaped to JSON with a default data-source field, appended."""
    base = fl.run_dir(spark, "shape")
    q = fl.append_to_store(fl.shape_records(_events_stream(spark, d), "EVENTS1"), f"{base}/data", f"{base}/_checkpoint")
    fl.await_done(q)
    return spark.read.parquet(f"{base}/data")


def strm3_upsert(spark: SparkSession, d: str) -> DataFrame:
    """STRM3: per user the latest event type, kept current by a continuous upsert."""
    base = fl.run_dir(spark, "upsert")
    stream = _events_stream(spark, d).select(
        F.col("user_id").alias("nid"), F.col("event_type").alias("sname"), F.col("ts").alias("last_modified"), "event_id"
    )
    q = fl.upsert_stream(stream, "nid", ["sname"], ["last_modified", "event_id"], f"{base}/log", f"{base}/_checkpoint")
    fl.await_done(q)
    return fl.read_upserted(spark, f"{base}/log", "nid", ["sname"], ["last_modified", "event_id"])


def strm6_rollup(spark: SparkSession, d: str) -> DataFrame:
    """STRM6: value summed per day, user and event type."""
    base = fl.run_dir(spark, "rollup")
    q = fl.rollup_stream(_events_stream(spark, d), "ts", ["user_id", "event_type"], "value", f"{base}/log", f"{base}/_checkpoint")
    fl.await_done(q)
    return fl.read_rollup(spark, f"{base}/log", ["user_id", "event_type"], "value")


def strm7_first_insert(spark: SparkSession, d: str) -> DataFrame:
    """STRM7: first insert per table and day, always current."""
    base = fl.run_dir(spark, "track")
    q = fl.first_insert_stream(_events_stream(spark, d), "event_type", "ts", f"{base}/log", f"{base}/_checkpoint")
    fl.await_done(q)
    return fl.read_first_inserts(spark, f"{base}/log")


def _arrivals(spark: SparkSession, d: str) -> list[DataFrame]:
    """The events in three deliveries by time; one event in fifty comes with the last, however old it is."""
    events = Tables(spark, d).events
    delayed = F.col("event_id") % 50 == 7
    cuts = [F.lit(c).cast("timestamp_ntz") for c in DELIVERY_CUTS]
    first, second, third = F.col("ts") < cuts[0], (F.col("ts") >= cuts[0]) & (F.col("ts") < cuts[1]), F.col("ts") >= cuts[1]
    return [events.filter(~delayed & first), events.filter(~delayed & second), events.filter(delayed | third)]


def _delivered(spark: SparkSession, d: str, name: str, start) -> str:
    """Deliveries land one after the other; the stream runs after each and goes on from its checkpoint."""
    base = fl.run_dir(spark, name)
    for delivery in _arrivals(spark, d):
        delivery.write.mode("append").parquet(f"{base}/landing")
        fl.await_done(start(fl.file_stream(spark, f"{base}/landing", fl.EVENT_SCHEMA), f"{base}/log", f"{base}/_checkpoint"))
    return f"{base}/log"


def strm6_late_rows(spark: SparkSession, d: str) -> DataFrame:
    """STRM6 over three deliveries: groups of the rows in time, and the late rows of the side output."""
    dims = ["user_id", "event_type"]
    log = _delivered(spark, d, "late", lambda s, path, ckpt: fl.rollup_stream(s, "ts", dims, "value", path, ckpt))
    fl.compact_partials(spark, log, ["day", *dims], {"value": "sum", "rows": "sum"})
    groups = fl.read_rollup(spark, log, dims, "value").select(F.lit("group").alias("kind"), "day", *dims, "value", "rows", F.lit(None).cast("bigint").alias("event_id"))
    late = fl.read_late(spark, log, fl.EVENT_SCHEMA)
    return groups.unionByName(late.select(F.lit("late").alias("kind"), F.to_date("ts").alias("day"), *dims, "value", F.lit(1).cast("bigint").alias("rows"), "event_id"))


def strm7_late_inserts(spark: SparkSession, d: str) -> DataFrame:
    """STRM7 over three deliveries: first inserts, and the number of late rows per table and day."""
    log = _delivered(spark, d, "late-track", lambda s, path, ckpt: fl.first_insert_stream(s, "event_type", "ts", path, ckpt))
    late = fl.read_late(spark, log, fl.EVENT_SCHEMA).groupBy(F.col("event_type").alias("table_name"), F.to_date("ts").alias("day"))
    return fl.read_first_inserts(spark, log).join(late.agg(F.count(F.lit(1)).alias("late_rows")), ["table_name", "day"], "full_outer")


def strm1_max_value(spark: SparkSession, d: str) -> DataFrame:
    """STRM1: a table that grows three times, read by its largest key and appended; every row once."""
    from ..streaming.max_value import max_value_stream  # needs pyarrow, as no other flow does

    base = fl.run_dir(spark, "max-value")
    events = Tables(spark, d).events
    third = events.agg(F.expr("max(event_id) div 3")).scalar()
    for part in (F.col("event_id") <= third, (F.col("event_id") > third) & (F.col("event_id") <= 2 * third), F.col("event_id") > 2 * third):
        events.filter(part).write.mode("append").parquet(f"{base}/table")
        stream = max_value_stream(spark, f"{base}/table", fl.EVENT_SCHEMA, "event_id")
        fl.await_done(fl.append_to_store(fl.clean_records(stream), f"{base}/data", f"{base}/_checkpoint"))
    return spark.read.parquet(f"{base}/data")


QUERIES = {
    "strm5_append_store": strm5_append_store,
    "strm4_shaping": strm4_shaping,
    "strm3_upsert": strm3_upsert,
    "strm6_rollup": strm6_rollup,
    "strm7_first_insert": strm7_first_insert,
    "strm1_max_value": strm1_max_value,
    "strm6_late_rows": strm6_late_rows,
    "strm7_late_inserts": strm7_late_inserts,
}

#: The events with the delivery they come in, and whether their day had ended before that by the watermark.
_LATE = f"""
WITH delivered AS (
  SELECT *, CASE WHEN event_id % 50 = 7 THEN 3 WHEN ts < TIMESTAMP '{DELIVERY_CUTS[0]}' THEN 1 WHEN ts < TIMESTAMP '{DELIVERY_CUTS[1]}' THEN 2 ELSE 3 END AS delivery
  FROM events),
marked AS (
  SELECT *, coalesce(CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) <=
    (SELECT max(e.ts) FROM delivered e WHERE e.delivery < delivered.delivery) - INTERVAL 1 HOUR, false) AS late
  FROM delivered)
"""

SQL = {
    "strm1_max_value": (
        "SELECT event_id, ts, user_id, upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) AS event_type, "
        "coalesce(value, 0.0) AS value, props FROM events"
    ),
    "strm6_late_rows": _LATE + """
SELECT 'group' AS kind, CAST(ts AS DATE) AS day, user_id, event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value,
       count(*) AS rows, CAST(NULL AS BIGINT) AS event_id FROM marked WHERE NOT late GROUP BY 2, 3, 4
UNION ALL SELECT 'late', CAST(ts AS DATE), user_id, event_type, value, 1, event_id FROM marked WHERE late
""",
    "strm7_late_inserts": _LATE + """
SELECT event_type AS table_name, CAST(ts AS DATE) AS day, min(ts) FILTER (WHERE NOT late) AS first_insert,
       nullif(count(*) FILTER (WHERE late), 0) AS late_rows FROM marked GROUP BY 1, 2
""",
    "strm5_append_store": (
        "SELECT event_id, ts, user_id, upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) AS event_type, "
        "coalesce(value, 0.0) AS value, props FROM events"
    ),
    "strm4_shaping": (
        "SELECT event_id, CAST(to_json({'event_id': event_id, 'ts': strftime(ts, '%Y-%m-%d %H:%M:%S'), 'user_id': user_id, "
        "'event_type': event_type, 'value': value, 'dataSource': 'EVENTS1'}) AS VARCHAR) AS record FROM events"
    ),
    "strm3_upsert": (
        "SELECT user_id AS nid, arg_max(event_type, (ts, event_id)) AS sname, min(ts) AS dw_insert_date, max(ts) AS dw_update_date "
        "FROM events GROUP BY user_id"
    ),
    "strm6_rollup": (
        "SELECT CAST(ts AS DATE) AS day, user_id, event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value, "
        "count(*) AS rows FROM events GROUP BY 1, 2, 3"
    ),
    "strm7_first_insert": "SELECT event_type AS table_name, CAST(ts AS DATE) AS day, min(ts) AS first_insert FROM events GROUP BY 1, 2",
}
