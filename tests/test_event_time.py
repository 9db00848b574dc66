"""The max-value source over a growing table, and late rows of event-time groups."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.streaming import flows as fl
from strata.streaming.max_value import MaxValueReader, max_value_stream

SCHEMA = "id long, v string, ts timestamp_ntz"


def _rows(spark, low, high):
    return spark.range(low, high, 1, 3).select(
        "id", F.concat(F.lit("v"), "id").alias("v"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts")
    )


@pytest.mark.parametrize("column", ["id", "ts"])
def test_max_value_source_reads_each_row_once(spark, tmp_dir, column):
    table, out, ckpt = f"{tmp_dir}/t", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    fail = {"on": True}

    def sink(batch, batch_id):
        fl._write_batch_partition(batch, out, batch_id)
        if batch_id == 1 and fail["on"]:
            raise RuntimeError("lost in the middle of a batch")

    def run():
        stream = max_value_stream(spark, table, SCHEMA, column)
        fl.await_done(stream.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start())

    _rows(spark, 0, 100).write.parquet(table)
    run()
    _rows(spark, 100, 150).write.mode("append").parquet(table)
    with pytest.raises(Exception, match="lost in the middle"):
        run()
    _rows(spark, 150, 180).write.mode("append").parquet(table)  # it grows before the restart
    fail["on"] = False
    run()
    run()  # nothing new
    _rows(spark, 180, 200).write.mode("append").parquet(table)
    run()
    got = spark.read.parquet(out)
    assert sorted(tuple(r) for r in got.select("id", "v").collect()) == [(i, f"v{i}") for i in range(200)]
    assert got.select("batch_id").distinct().count() >= 4


def test_max_value_reader_skips_row_groups_that_were_read(spark, tmp_dir):
    from pyspark.sql.types import StructType

    table = f"{tmp_dir}/t"
    _rows(spark, 0, 90).write.parquet(table)
    reader = MaxValueReader(StructType.fromDDL(SCHEMA), {"path": table, "column": "id"})
    first = reader.latestOffset()
    assert first == {"value": 89} and len(reader.partitions(reader.initialOffset(), first)) == 3
    _rows(spark, 90, 120).write.mode("append").parquet(table)
    second = reader.latestOffset()
    assert second == {"value": 119} and len(reader.partitions(first, second)) == 3
    assert reader.partitions(second, second) == []
    read = [r for p in reader.partitions(first, second) for b in reader.read(p) for r in b.column("id").to_pylist()]
    assert sorted(read) == list(range(90, 120))
    assert MaxValueReader(StructType.fromDDL(SCHEMA), {"path": f"{tmp_dir}/none", "column": "id"}).latestOffset() == {"value": None}


def _event(spark, rows):
    at = lambda day, hour: dt.datetime(2024, 5, day, hour)
    return spark.createDataFrame([(i, at(day, hour), 1, kind, float(value), "") for i, day, hour, kind, value in rows], fl.EVENT_SCHEMA)


def test_late_rows_go_to_the_side_output_and_nowhere_else(spark, tmp_dir):
    landing, log, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/log", f"{tmp_dir}/ck"
    deliveries = [
        [(1, 1, 5, "a", 1), (2, 1, 23, "a", 2), (3, 2, 0, "a", 4)],
        [(4, 1, 9, "a", 8), (5, 2, 1, "a", 16)],  # day 1 ended, but the watermark is an hour behind: in time
        [(6, 1, 10, "a", 32), (7, 2, 3, "b", 64)],
        [(9, 2, 4, "a", 128), (10, 1, 1, "b", 256)],
    ]
    for rows in deliveries:
        _event(spark, rows).write.mode("append").parquet(landing)
        stream = fl.file_stream(spark, landing, fl.EVENT_SCHEMA)
        fl.await_done(fl.rollup_stream(stream, "ts", ["event_type"], "value", log, ckpt))
    got = {(str(r["day"]), r["event_type"]): (r["value"], r["rows"]) for r in fl.read_rollup(spark, log, ["event_type"], "value").collect()}
    assert got == {("2024-05-01", "a"): (11.0, 3), ("2024-05-02", "a"): (148.0, 3), ("2024-05-02", "b"): (64.0, 1)}
    assert sorted(r["event_id"] for r in fl.read_late(spark, log, fl.EVENT_SCHEMA).collect()) == [6, 10]
    # what is kept is a row per group once the log is folded
    fl.compact_partials(spark, log, ["day", "event_type"], {"value": "sum", "rows": "sum"})
    assert fl._effective_log(spark, log).count() == 3


def test_a_replayed_batch_changes_nothing(spark, tmp_dir):
    landing, log = f"{tmp_dir}/in", f"{tmp_dir}/log"
    _event(spark, [(1, 1, 5, "a", 1)]).write.parquet(landing)
    for ckpt in ("ck1", "ck2"):  # the second query replays batch 0
        fl.await_done(fl.first_insert_stream(fl.file_stream(spark, landing, fl.EVENT_SCHEMA), "event_type", "ts", log, f"{tmp_dir}/{ckpt}"))
    assert [(r["table_name"], r["first_insert"]) for r in fl.read_first_inserts(spark, log).collect()] == [("a", dt.datetime(2024, 5, 1, 5))]
    assert spark.read.parquet(log).count() == 1
