"""Sources, sinks and streaming: write -> read back, multi-batch streams, replay."""

from __future__ import annotations

import os
import re

import pytest

from pyspark.sql import functions as F

from strata.plans.model import Model
from strata.sources import files as fs
from strata.sources import tables as tb
from strata.streaming import flows as fl
from tests.conftest import SF_SMALL


def test_lake_csv_round_trip(spark, tmp_dir):
    shop = Model(spark, SF_SMALL).shop
    path = f"{tmp_dir}/lake/shop"
    fs.write_lake_csv(shop, path)
    back = fs.read_lake_csv(spark, path, shop.columns)
    assert all(t == "string" for _, t in back.dtypes)
    assert back.count() == shop.count()
    typed = back.select(F.col("nid").try_cast("bigint").alias("nid"))
    assert sorted(r[0] for r in typed.collect()) == sorted(r[0] for r in shop.select("nid").collect())


def test_csv_with_bom_and_mixed_case_header(spark, tmp_dir):
    path = f"{tmp_dir}/in.csv"
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("Id,EncryptedRIB\n1,abc\n2,def\n")
    df = fs.read_csv_with_header(spark, path)
    assert sorted(r["id"] for r in df.select("id").collect()) == ["1", "2"]
    assert df.select("encryptedrib").count() == 2


def test_json_records_with_declared_schema(spark, tmp_dir):
    path = f"{tmp_dir}/rec.json"
    with open(path, "w") as f:
        f.write('{"nid":"42","nshopid":"kiosk-7","dinsertion":"2023-02-03T04:05:06Z","sbillerid":"b9","namount":7.25}\n')
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(c, T.StringType()) for c in ["nid", "nshopid", "dinsertion", "sbillerid"]] + [
        T.StructField("namount", T.DoubleType())
    ])
    df = fs.read_json_records(spark, path, schema, ts_col="dinsertion")
    r = df.collect()[0]
    assert r["namount"] == 7.25 and str(r["dinsertion"]).startswith("2023-02-03 04:05:06")


def test_sinks(spark, tmp_dir):
    df = Model(spark, SF_SMALL).orders
    fs.create_empty_then_append(df, f"{tmp_dir}/t1")
    assert spark.read.parquet(f"{tmp_dir}/t1").count() == df.count()
    fs.append(df, f"{tmp_dir}/t1")
    assert spark.read.parquet(f"{tmp_dir}/t1").count() == 2 * df.count()
    fs.replace(df, f"{tmp_dir}/t1")
    assert spark.read.parquet(f"{tmp_dir}/t1").count() == df.count()
    a, b = fs.write_twice(df, f"{tmp_dir}/b1", f"{tmp_dir}/b2")
    assert a == b == df.count()
    out = fs.export_csv_with_stamp(df, f"{tmp_dir}/export", "2024-06-30 12:00:00")
    assert out.endswith("_20240630") and spark.read.option("header", True).csv(out).count() == df.count()
    ev = tb.read_table(spark, SF_SMALL, "events")
    fs.write_time_partitioned(ev, f"{tmp_dir}/ev", "ts")
    parts = [p for p in os.listdir(f"{tmp_dir}/ev") if p.startswith("event_date=")]
    assert len(parts) == ev.select(F.to_date("ts")).distinct().count()
    day = sorted(parts)[0].split("=")[1]
    pruned = spark.read.parquet(f"{tmp_dir}/ev").filter(F.col("event_date") == day)
    assert "PartitionFilters" in pruned._jdf.queryExecution().executedPlan().toString()


def _land(spark, ev, landing, days):
    # one file per day, written in order so the file source sees them in time order
    for d in days:
        ev.filter(F.to_date("ts") == d).coalesce(1).write.mode("append").parquet(landing)


def test_stream_multi_batch_upsert_and_replay(spark, tmp_dir):
    ev = tb.read_table(spark, SF_SMALL, "events")
    days = [r[0] for r in ev.select(F.to_date("ts").alias("d")).distinct().orderBy("d").limit(4).collect()]
    landing = f"{tmp_dir}/landing"
    _land(spark, ev, landing, days[:2])
    log, ck = f"{tmp_dir}/log", f"{tmp_dir}/ck"

    def run():
        s = fl.file_stream(spark, landing, fl.EVENT_SCHEMA, max_files=1).select(
            F.col("user_id").alias("nid"), F.col("event_type").alias("sname"), F.col("ts").alias("last_modified"), "event_id"
        )
        fl.await_done(fl.upsert_stream(s, "nid", ["sname"], ["last_modified", "event_id"], log, ck))

    run()
    fl.compact_upsert_log(spark, log, "nid", ["sname"], ["last_modified", "event_id"])
    _land(spark, ev, landing, days[2:])
    run()  # restart from the checkpoint: only the new files are read
    batches = {r[0] for r in spark.read.parquet(log).select("batch_id").distinct().collect()}
    assert len(batches) == 4
    got = fl.read_upserted(spark, log, "nid", ["sname"], ["last_modified", "event_id"])
    seen = ev.filter(F.to_date("ts").isin(days))
    want = seen.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("sname"))
    assert sorted((r["nid"], r["sname"]) for r in got.collect()) == sorted((r[0], r[1]) for r in want.collect())
    # replaying a batch id overwrites its own partition only
    before = spark.read.parquet(log).count()
    fl._write_batch_partition(spark.read.parquet(log).filter("batch_id = 0").drop("batch_id"), log + "_copy", 0)
    fl._write_batch_partition(spark.read.parquet(log).filter("batch_id = 0").drop("batch_id"), log + "_copy", 0)
    assert spark.read.parquet(log + "_copy").count() == spark.read.parquet(log).filter("batch_id = 0").count()
    assert spark.read.parquet(log).count() == before


def test_stream_rollup_matches_batch(spark, tmp_dir):
    ev = tb.read_table(spark, SF_SMALL, "events")
    days = [r[0] for r in ev.select(F.to_date("ts").alias("d")).distinct().orderBy("d").collect()]
    landing = f"{tmp_dir}/landing"
    _land(spark, ev, landing, days[:5])
    s = fl.file_stream(spark, landing, fl.EVENT_SCHEMA, max_files=1)
    fl.await_done(fl.rollup_stream(s, "ts", ["event_type"], "value", f"{tmp_dir}/log", f"{tmp_dir}/ck"))
    before = fl.read_rollup(spark, f"{tmp_dir}/log", ["event_type"], "value").collect()
    fl.compact_partials(spark, f"{tmp_dir}/log", ["day", "event_type"], {"value": "sum", "rows": "sum"})
    got = fl.read_rollup(spark, f"{tmp_dir}/log", ["event_type"], "value")
    assert sorted(map(tuple, before)) == sorted(map(tuple, got.collect()))
    assert fl.read_late(spark, f"{tmp_dir}/log", fl.EVENT_SCHEMA).count() == 0
    sub = ev.filter(F.to_date("ts").isin(days[:5]))
    want = sub.groupBy(F.to_date("ts").alias("day"), "event_type").agg(
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value"), F.count(F.lit(1)).alias("rows")
    )
    assert sorted(tuple(r) for r in got.select("day", "event_type", "value", "rows").collect()) == sorted(
        tuple(r) for r in want.collect()
    )


def test_versioned_warehouse_jobs(spark, tmp_dir):
    from strata.operators import clean as cl
    from strata.plans.loading_queries import source_v0, source_v1
    from strata.sources import warehouse as wh

    base = f"{tmp_dir}/dest_customer"
    assert wh.read_current(spark, base) is None
    assert wh.run_version_load(spark, base, source_v0(spark, SF_SMALL), "c_custkey", "2024-06-01 00:00:00") == 1
    assert wh.run_version_load(spark, base, source_v1(spark, SF_SMALL), "c_custkey", "2024-06-30 12:00:00") == 2
    cur = wh.read_current(spark, base)
    open_rows = cur.filter("flag = 1")
    assert open_rows.groupBy("c_custkey").count().filter("count > 1").count() == 0
    assert open_rows.count() == source_v1(spark, SF_SMALL).count()
    # a rerun with the same input adds a version with the same rows
    assert wh.run_version_load(spark, base, source_v1(spark, SF_SMALL), "c_custkey", "2024-07-01 00:00:00") == 3
    assert wh.read_current(spark, base).count() == cur.count()
    assert wh.last_commit(spark, base)[1].startswith("2024-07-01")

    fact = Model(spark, SF_SMALL).trx
    b2 = f"{tmp_dir}/stge_trx"
    first = fact.filter("nid < 1000")
    assert wh.run_incremental_append(spark, b2, first, "nid", "2024-06-01 00:00:00", cl.clean_trx) == 1
    assert wh.run_incremental_append(spark, b2, fact, "nid", "2024-06-02 00:00:00", cl.clean_trx) == 2
    out = wh.read_current(spark, b2)
    assert out.count() == fact.count() and out.filter("noperationfee IS NULL").count() == 0


def test_landing_day_and_full_snapshot(spark, tmp_dir):
    from strata.operators import loading as ld

    ev = tb.read_table(spark, SF_SMALL, "events").withColumn("ingest_date", F.to_date("ts"))
    ev.write.partitionBy("ingest_date").parquet(f"{tmp_dir}/landing")
    landed = spark.read.parquet(f"{tmp_dir}/landing")
    day = tb.landing_day(landed, "ingest_date", "2024-01-16")
    assert day.count() == ev.filter(F.col("ingest_date") == "2024-01-15").count()
    path = ld.write_full_snapshot(Model(spark, SF_SMALL).customer, tmp_dir, "customer", "20240630")
    assert path.endswith("customer_FULL_20240630") and spark.read.parquet(path).count() == 150
    assert tb.literal_rows(spark, [(1, "a")], "id int, v string").count() == 1
    from strata.operators.versioning import is_empty

    assert is_empty(ev.filter("1 = 0")) and not is_empty(ev)


def test_version_job_methods_agree(spark, tmp_dir):
    from strata.plans.loading_queries import HASH_COLS, _stamped_v1, source_v0, source_v1
    from strata.sources import warehouse as wh

    t0, t1 = "2024-06-01 00:00:00", "2024-06-30 12:00:00"
    results = {}
    for method in ["compare", "hash", "since"]:
        base = f"{tmp_dir}/{method}"
        v0 = source_v0(spark, SF_SMALL).withColumn("last_updated", F.lit(t0).cast("timestamp_ntz"))
        wh.run_version_load(spark, base, v0, "c_custkey", t0, method, HASH_COLS, "last_updated")
        src = _stamped_v1(spark, SF_SMALL) if method == "since" else source_v1(spark, SF_SMALL).withColumn(
            "last_updated", F.lit(t1).cast("timestamp_ntz")
        )
        wh.run_version_load(spark, base, src, "c_custkey", t1, method, HASH_COLS, "last_updated")
        cur = wh.read_current(spark, base).drop("row_hash")
        cols = sorted(cur.columns)
        results[method] = sorted(tuple(r) for r in cur.select(*cols).collect())
    assert results["compare"] == results["hash"] == results["since"]


def test_bucketed_since_load_rewrites_only_touched_buckets(spark, tmp_dir):
    import glob

    from strata.plans.loading_queries import _stamped_v1, source_v0, ver3_compare
    from strata.sources import warehouse as wh

    path = f"{tmp_dir}/dest_customer_b"
    t0, t1 = "2024-06-01 00:00:00", "2024-06-30 12:00:00"
    v0 = source_v0(spark, SF_SMALL).withColumn("last_updated", F.lit(t0).cast("timestamp_ntz"))
    wh.run_bucketed_since_load(spark, path, v0, "c_custkey", "last_updated", t0, buckets=32)
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{path}/bucket=*/*.parquet")}
    touched = wh.run_bucketed_since_load(spark, path, _stamped_v1(spark, SF_SMALL), "c_custkey", "last_updated", t1, buckets=32)
    assert 0 < len(touched) < 32
    after = {p: os.path.getmtime(p) for p in glob.glob(f"{path}/bucket=*/*.parquet")}
    untouched = [p for p in before if int(p.split("bucket=")[1].split("/")[0]) not in touched]
    assert untouched and all(p in after and after[p] == before[p] for p in untouched)
    got = spark.read.parquet(path).drop("bucket")
    want = ver3_compare(spark, SF_SMALL)
    cols = sorted(want.columns)
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(tuple(r) for r in want.select(*cols).collect())
    # a rerun with the same input changes nothing
    wh.run_bucketed_since_load(spark, path, _stamped_v1(spark, SF_SMALL), "c_custkey", "last_updated", t1, buckets=32)
    assert spark.read.parquet(path).count() == want.count()


def test_bucketed_upsert(spark, tmp_dir):
    from strata.plans.loading_queries import _product_changes, _product_target, ups1_upsert
    from strata.sources import warehouse as wh

    path = f"{tmp_dir}/product_dw"
    target = _product_target(spark, SF_SMALL)
    # seed the bucketed table with the existing target rows (as of T0)
    target.withColumn("bucket", wh.key_bucket("nid", 16)).write.partitionBy("bucket").parquet(path)
    touched = wh.run_bucketed_upsert(
        spark, path, _product_changes(spark, SF_SMALL), "nid", ["sname", "last_modified"], ["last_modified"],
        "2024-06-30 12:00:00", buckets=16,
    )
    assert touched
    got = spark.read.parquet(path).drop("bucket")
    want = ups1_upsert(spark, SF_SMALL)
    cols = sorted(want.columns)
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(tuple(r) for r in want.select(*cols).collect())


def test_bucketed_hash_load(spark, tmp_dir):
    from strata.plans.loading_queries import HASH_COLS, source_v0, source_v1, ver5_hash
    from strata.sources import warehouse as wh

    path = f"{tmp_dir}/dest_customer_h"
    wh.run_bucketed_hash_load(spark, path, source_v0(spark, SF_SMALL), "c_custkey", HASH_COLS, "2024-06-01 00:00:00", buckets=32)
    touched = wh.run_bucketed_hash_load(spark, path, source_v1(spark, SF_SMALL), "c_custkey", HASH_COLS, "2024-06-30 12:00:00", buckets=32)
    assert 0 < len(touched) <= 32
    got = spark.read.parquet(path).drop("bucket")
    want = ver5_hash(spark, SF_SMALL)
    cols = sorted(want.columns)
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(tuple(r) for r in want.select(*cols).collect())
    # same input again: no changed key, nothing rewritten
    assert wh.run_bucketed_hash_load(spark, path, source_v1(spark, SF_SMALL), "c_custkey", HASH_COLS, "2024-07-01 00:00:00", buckets=32) == []


def test_bucketed_compare_load(spark, tmp_dir):
    from strata.plans.loading_queries import source_v0, source_v1, ver3_compare
    from strata.sources import warehouse as wh

    path = f"{tmp_dir}/dest_customer_c"
    args = dict(key="c_custkey", hash_cols=[], buckets=32, method="compare")
    wh.run_bucketed_hash_load(spark, path, source_v0(spark, SF_SMALL), as_of="2024-06-01 00:00:00", **args)
    touched = wh.run_bucketed_hash_load(spark, path, source_v1(spark, SF_SMALL), as_of="2024-06-30 12:00:00", **args)
    assert 0 < len(touched) <= 32
    got = spark.read.parquet(path).drop("bucket")
    want = ver3_compare(spark, SF_SMALL)
    cols = sorted(want.columns)
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(tuple(r) for r in want.select(*cols).collect())
    assert wh.run_bucketed_hash_load(spark, path, source_v1(spark, SF_SMALL), as_of="2024-07-01 00:00:00", **args) == []


def test_a_failing_read_is_not_an_empty_target(spark, tmp_dir):
    """A target that can't be read stays as it is, and the load fails."""
    from pathlib import Path

    from strata.plans.loading_queries import source_v0
    from strata.sources import warehouse as wh

    base = Path(tmp_dir) / "broken"
    (base / "_commits").mkdir(parents=True)
    (base / "_commits" / "part-0.parquet").write_bytes(b"this is no parquet file")
    with pytest.raises(Exception, match="part-0"):
        wh.run_version_load(spark, str(base), source_v0(spark, SF_SMALL), "c_custkey", "2024-06-01 00:00:00")
    assert not (base / "data").exists()
    table = Path(tmp_dir) / "bucketed"
    table.mkdir()
    (table / "part-0.parquet").write_bytes(b"neither")
    with pytest.raises(Exception):
        wh.run_bucketed_hash_load(spark, str(table), source_v0(spark, SF_SMALL), "c_custkey", ["c_name"], "2024-06-01 00:00:00")
    assert (table / "part-0.parquet").read_bytes() == b"neither"


def test_append_job_writes_added_rows_only(spark, tmp_dir):
    from pathlib import Path

    from strata.sources import warehouse as wh

    base = f"{tmp_dir}/facts"
    rows = spark.range(1, 101).withColumnRenamed("id", "nid")
    for upto, version in ((40, 1), (70, 2), (100, 3)):
        assert wh.run_incremental_append(spark, base, rows.filter(F.col("nid") <= upto), "nid", "2024-06-01 00:00:00") == version
        assert sorted(r["nid"] for r in wh.read_current(spark, base).collect()) == list(range(1, upto + 1))
    assert [spark.read.parquet(f"{base}/data/v={v}").count() for v in (1, 2, 3)] == [40, 30, 30]
    assert Path(f"{base}/_commits").exists()


def test_bucket_count_is_stored_with_the_table(spark, tmp_dir):
    from strata.plans.loading_queries import HASH_COLS, source_v0, source_v1
    from strata.sources import warehouse as wh

    path = f"{tmp_dir}/t"
    wh.run_bucketed_hash_load(spark, path, source_v0(spark, SF_SMALL), "c_custkey", HASH_COLS, "2024-06-01 00:00:00", buckets=16)
    assert wh.bucket_count(spark, path) == 16
    wh.run_bucketed_hash_load(spark, path, source_v1(spark, SF_SMALL), "c_custkey", HASH_COLS, "2024-06-30 12:00:00", buckets=99)
    per_key = spark.read.parquet(path).groupBy("c_custkey").agg(F.countDistinct("bucket").alias("n"), F.max("bucket").alias("b"))
    assert per_key.filter("n > 1").isEmpty() and per_key.agg(F.max("b")).first()[0] < 16


def test_a_batch_that_lands_during_compaction_is_not_lost(spark, tmp_dir, monkeypatch):
    log = f"{tmp_dir}/log"

    def batch(n: int) -> None:
        fl._write_batch_partition(spark.createDataFrame([(n, float(n), 1)], "k long, value double, rows long"), log, n)

    batch(0)
    batch(1)
    real = fl._effective_log

    def and_a_batch(spark_, path, last=None):
        if last is not None:
            monkeypatch.setattr(fl, "_effective_log", real)
            batch(2)
        return real(spark_, path, last)

    monkeypatch.setattr(fl, "_effective_log", and_a_batch)
    fl.compact_group_log(spark, log, ["k"], ["value", "rows"])
    got = fl.read_latest_groups(spark, log, ["k"], ["value", "rows"])
    assert sorted(r["k"] for r in got.collect()) == [0, 1, 2]
    fl.compact_group_log(spark, log, ["k"], ["value", "rows"])
    assert sorted(r["k"] for r in fl.read_latest_groups(spark, log, ["k"], ["value", "rows"]).collect()) == [0, 1, 2]


def test_incremental_bound_reaches_the_scan(spark):
    from strata.plans.loading_queries import load2_incremental

    df = load2_incremental(spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"DataFilters: \[[^\]]*o_orderkey#\d+L > (scalar-)?[sS]ubquery", plan)
