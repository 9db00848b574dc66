"""Registered queries of sources, sinks and table states: each writes, reads back and returns what it read.

Rows derive from the driver's tables, so the work grows with them; folders are fresh ones
under the shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import difference, loading as ld
from ..operators import versioning as vs
from ..operators.lists import list_pieces, rendered
from ..operators.windows import partitioned_numbering
from ..session import scratch_path
from ..sources import files, warehouse
from ..sources.tables import SCHEMAS, Tables, discover, landing_day, read_table
from .analytics import _employee_calls, positioned
from .loading_queries import HASH_COLS, KEY, T0, T1, source_v0, source_v1
from .model import Model

#: Categories that TYP2 expects; the data has one more.
EVENT_DOMAIN = ("click", "purchase", "signup", "view")
RUN_DATE = "2024-01-16"


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, "storage", f"{name}-{uuid.uuid4().hex}")


def src6_discovery(spark: SparkSession, d: str) -> DataFrame:
    """A folder with one table as declared, one that changed, one unknown and one missing; known tables are counted."""
    base, t = _folder(spark, "discovery"), Tables(spark, d)
    declared = {n: SCHEMAS[n] for n in ("nation", "region", "supplier")}
    files.replace(t.nation, f"{base}/nation.parquet")
    files.replace(t.region.withColumn("r_comment", F.lit("new")).withColumn("r_regionkey", F.col("r_regionkey").cast("bigint")), f"{base}/region.parquet")
    files.replace(t.customer.select("c_custkey", "c_name"), f"{base}/clients.parquet")
    found = discover(spark, base, declared)
    report = spark.createDataFrame([(n, *f) for n, f in found.items()], "table_name string, status string, detail string")
    known = [n for n, (status, _) in found.items() if status == "known"]
    counts = [spark.read.schema(SCHEMAS[n]).parquet(f"{base}/{n}.parquet").agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for n in known]
    all_counts = counts[0]
    for c in counts[1:]:
        all_counts = all_counts.unionByName(c)
    return report.join(all_counts, "table_name", "left")


def src8_landing(spark: SparkSession, d: str) -> DataFrame:
    """Files landed by day; the run takes those of the day before."""
    path = _folder(spark, "landing")
    files.write_time_partitioned(Tables(spark, d).events, path, "ts")
    return landing_day(spark.read.parquet(path), "event_date", RUN_DATE).drop("event_date")


def src9_csv_header(spark: SparkSession, d: str) -> DataFrame:
    """SNK6 and SRC9: a date-stamped CSV export with header, read back by lower-case names."""
    path = files.export_csv_with_stamp(Model(spark, d).product, _folder(spark, "export"), T1)
    back = files.read_csv_with_header(spark, path)
    return back.select(F.col("NID").cast("bigint").alias("nid"), F.col("SName").alias("sname"), F.lit(path[-8:]).alias("stamp"))


def src10_json(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines with a declared schema, the time parsed."""
    path = _folder(spark, "json")
    events = Tables(spark, d).events.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"), "event_type", "value")
    events.write.json(path)
    back = files.read_json_records(spark, path, events.schema, "ts")
    return back.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def snk1_append(spark: SparkSession, d: str) -> DataFrame:
    path, c = _folder(spark, "append"), Tables(spark, d).customer
    files.append(c.filter(F.col(KEY) % 2 == 0), path)
    files.append(c.filter(F.col(KEY) % 2 == 1), path)
    return spark.read.schema(SCHEMAS["customer"]).parquet(path)


def snk2_replace(spark: SparkSession, d: str) -> DataFrame:
    path, c = _folder(spark, "replace"), Tables(spark, d).customer
    files.replace(c, path)
    files.replace(c.filter(F.col(KEY) % 3 == 0), path)
    return spark.read.schema(SCHEMAS["customer"]).parquet(path)


def snk3_create_then_append(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "create")
    files.create_empty_then_append(Tables(spark, d).supplier, path)
    return spark.read.schema(SCHEMAS["supplier"]).parquet(path)


def snk5_twice(spark: SparkSession, d: str) -> DataFrame:
    """Two copies of the same rows; each says which it is, so both are compared."""
    a, b = _folder(spark, "first"), _folder(spark, "second")
    files.write_twice(Tables(spark, d).supplier, a, b)
    read = lambda path, name: spark.read.schema(SCHEMAS["supplier"]).parquet(path).withColumn("copy", F.lit(name))
    return read(a, "first").unionByName(read(b, "second"))


def snk7_time_partitions(spark: SparkSession, d: str) -> DataFrame:
    """Rows and files per day of a store whose days are split by their rows."""
    path = _folder(spark, "days")
    events = Tables(spark, d).events
    # most rows fall on one day
    skewed = events.withColumn("ts", F.when(F.col("event_id") % 10 != 0, F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")).otherwise(F.col("ts")))
    files.write_time_partitioned(skewed, path, "ts", rows_per_file=500)
    store = spark.read.parquet(path).withColumn("_file", F.input_file_name())
    per_day = store.groupBy("event_date").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("_file").alias("n_files"))
    return per_day.select("event_date", "n_rows", (F.col("n_files") > 1).alias("split"))


def snap1_full(spark: SparkSession, d: str) -> DataFrame:
    path = ld.write_full_snapshot(source_v0(spark, d), _folder(spark, "snapshots"), "customer", "20240601")
    return spark.read.schema(SCHEMAS["customer"]).parquet(path).withColumn("snapshot", F.lit(path.rsplit("/", 1)[1]))


def load1_branch(spark: SparkSession, d: str) -> DataFrame:
    """Two runs of one job: the first finds no target and loads all, the second compares."""
    base = _folder(spark, "load1")
    warehouse.run_version_load(spark, base, source_v0(spark, d), KEY, T0)
    warehouse.run_version_load(spark, base, source_v1(spark, d), KEY, T1)
    return warehouse.read_current(spark, base)


def agg8_pieces(spark: SparkSession, d: str) -> DataFrame:
    """The customer lists of request 6 in pieces of 64 characters."""
    calls = _employee_calls(Model(spark, d)).select(F.col("e.Employee_Name").alias("Employee_Name"), F.col("c.CustomerName").alias("CustomerName"))
    return rendered(list_pieces(calls, "Employee_Name", "CustomerName", piece_chars=64))


def typ2_domain(spark: SparkSession, d: str) -> DataFrame:
    """Events of a category outside the declared ones."""
    return ld.out_of_domain(Tables(spark, d).events, "event_type", EVENT_DOMAIN).select("event_id", "event_type")


def snap2_by_range(spark: SparkSession, d: str) -> DataFrame:
    return difference.differential_by_range(source_v0(spark, d), source_v1(spark, d, with_deletes=True), KEY)


def snap2_one_range(spark: SparkSession, d: str) -> DataFrame:
    """Few changes, all in one range of keys: the join reads that range only."""
    old = read_table(spark, d, "orders")
    price = F.when(F.col("o_orderkey").between(101, 140), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return difference.differential_by_range(old, old.withColumn("o_totalprice", price), "o_orderkey")


def ver3_by_range(spark: SparkSession, d: str) -> DataFrame:
    target = vs.initial_load(source_v0(spark, d), T0)
    return difference.scd2_compare_by_range(target, source_v1(spark, d), KEY, T1)


def win4_hot_tie(spark: SparkSession, d: str) -> DataFrame:
    """Ranks per return flag where most rows share one quantity: ties go over slices."""
    li = Tables(spark, d).lineitem
    key = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line")
    rows = li.select(key, "l_returnflag", F.when(F.col("l_linenumber") < 5, F.lit(0.0)).otherwise(F.col("l_quantity")).alias("quantity"))
    ranked = partitioned_numbering(rows, ["l_returnflag"], [("quantity", False)], "line")
    return ranked.select("line", "l_returnflag", "quantity", F.col("_rn").alias("row_number"), F.col("_rank").alias("rank"), F.col("_dense").alias("dense_rank"))


def srt1_position(spark: SparkSession, d: str) -> DataFrame:
    """Several keys in mixed directions (request 20)."""
    return positioned(spark, d, "req1_20")


def srt2_position(spark: SparkSession, d: str) -> DataFrame:
    """By an aggregate (request 1)."""
    return positioned(spark, d, "req1_01")


QUERIES = {
    f.__name__: f
    for f in (
        src6_discovery, src8_landing, src9_csv_header, src10_json, snk1_append, snk2_replace, snk3_create_then_append, snk5_twice,
        snk7_time_partitions, snap1_full, load1_branch, agg8_pieces, typ2_domain, snap2_by_range, snap2_one_range, ver3_by_range, win4_hot_tie,
        srt1_position, srt2_position,
    )
}
