"""Scans of the driver tables and of warehouse paths (SRC1-SRC6, SRC8, SRC11)."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# Declared schemas of the driver tables: reads skip footer-based schema inference
# and a file whose types drift fails at the scan instead of deep inside a plan.
SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """SRC1 full scan with the declared schema.  Parquet keeps column pruning and filter pushdown."""
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(table_path(sf_dir, name))


class Tables:
    """Lazy accessor: ``t = Tables(spark, dir); t.orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]


def incremental_by_key(source: DataFrame, key: str, last_max: Column | int) -> DataFrame:
    """SRC2: rows whose key is above the last loaded maximum (pushed to the scan)."""
    bound = last_max if isinstance(last_max, Column) else F.lit(last_max)
    return source.filter(F.col(key) > bound)


def incremental_by_time(source: DataFrame, ts_col: str, since: Column | str) -> DataFrame:
    """SRC3: rows changed after a watermark timestamp."""
    bound = since if isinstance(since, Column) else F.lit(since).cast("timestamp")
    return source.filter(F.col(ts_col).cast("timestamp") > bound)


def current_hash_scan(target: DataFrame, key: str, hash_col: str = "row_hash") -> DataFrame:
    """SRC4: narrow scan of a version table (key, hash, flag) limited to open rows."""
    return target.filter(F.col("flag") == 1).select(key, hash_col, "flag")


def rows_for_keys(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """SRC5: restrict a table to a set of keys with a semi join, no driver-side key list."""
    return target.join(keys.select(key).distinct(), on=key, how="left_semi")


#: What ``discover`` finds about a table.
KNOWN, UNKNOWN, CHANGED, MISSING = "known", "unknown", "changed", "missing"


def discover(spark: SparkSession, folder: str, declared: dict[str, str]) -> dict[str, tuple[str, str]]:
    """SRC6: the tables of a folder (``<name>.parquet``) against the declared schemas: name -> (status, detail).

    The folder is listed by Spark, so any store it reads will do; only footers are read.
    A table is changed if it lacks a declared column or has one of another type, or if it
    has columns that are not declared; the detail names them.
    """
    paths = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder)
    name = F.regexp_extract("path", r"/([^/]+)\.parquet(/|$)", 1)
    found = {r["name"]: r["path"] for r in paths.groupBy(name.alias("name")).agg(F.min("path").alias("path")).collect()}
    out: dict[str, tuple[str, str]] = {}
    for table in sorted(found.keys() | declared.keys()):
        if table not in found:
            out[table] = (MISSING, "")
            continue
        held = {f.name: f.dataType.simpleString() for f in spark.read.parquet(table_path(folder, table)).schema}
        if table not in declared:
            out[table] = (UNKNOWN, ", ".join(f"{c} {t}" for c, t in held.items()))
            continue
        want = {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(declared[table])}
        gone = [f"-{c} {t}" for c, t in want.items() if held.get(c) != t]
        more = [f"+{c} {t}" for c, t in held.items() if want.get(c) != t]
        out[table] = (CHANGED if gone or more else KNOWN, ", ".join(gone + more))
    return out


def for_each_table(names: Iterable[str], build: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    """SRC6: run the same plan builder over a set of tables (plans only, no data moves)."""
    return {n: build(n) for n in names}


def landing_day(df: DataFrame, day_col: str, run_date: str) -> DataFrame:
    """SRC8: files landed the day before the run date, on a date-partitioned folder."""
    return df.filter(F.col(day_col) == F.date_sub(F.to_date(F.lit(run_date)), 1))


def literal_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """SRC11: literal rows with an explicit schema (``INSERT ... VALUES``)."""
    return spark.createDataFrame(rows, schema)
