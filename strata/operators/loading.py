"""Upsert, snapshots, table tracking and data-quality checks.

UPS1 keyed upsert with audit dates, SNAP1-SNAP3 full / differential
snapshots and restore, TRK1-TRK3 first insert per table and day, Q1-Q4 key
and null checks and surrogate keys, ENC1 encrypt-if-missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.protect import encrypt_column, row_hash
from .windows import global_rank


def _ts(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp_ntz")


# ---------------------------------------------------------------- UPS1
def latest_per_key(df: DataFrame, key: str, order_cols: Sequence[str]) -> DataFrame:
    """The last row per key by ``order_cols`` (several versions of a key in one batch)."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order_cols])
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    key: str,
    update_cols: Sequence[str],
    as_of: str | Column,
    insert_col: str = "dw_insert_date",
    update_col: str = "dw_update_date",
) -> DataFrame:
    """UPS1: unmatched keys inserted, matched keys updated; audit dates maintained.

    Returns the whole new target (one full outer join on the key); written to
    a new path / partition since Parquet has no in-place update.
    """
    now = _ts(as_of)
    t = target.alias("t")
    s = incoming.alias("s")
    j = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    matched = F.col(f"s.{key}").isNotNull()
    cols = [F.coalesce(F.col(f"t.{key}"), F.col(f"s.{key}")).alias(key)]
    for c in update_cols:
        cols.append(F.when(matched, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    cols.append(F.coalesce(F.col(f"t.{insert_col}"), now).alias(insert_col))
    cols.append(F.when(matched, now).otherwise(F.col(f"t.{update_col}")).alias(update_col))
    return j.select(*cols)


def route_counts(incoming: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """JN12 as one pass: each incoming record tagged matched / unmatched by a left join marker."""
    keys = target.select(F.col(key).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    j = incoming.join(keys, incoming[key] == keys["_k"], "left")
    return j.select(*incoming.columns, F.when(F.col("_hit"), "matched").otherwise("unmatched").alias("route"))


# ---------------------------------------------------------------- SNAP
def snapshot_path(base: str, table: str, kind: str, stamp: str) -> str:
    """SNAP1 naming: ``<base>/<table>_<FULL|DIFF>_<stamp>``."""
    return f"{base.rstrip('/')}/{table}_{kind}_{stamp}"


def write_full_snapshot(df: DataFrame, base: str, table: str, stamp: str) -> str:
    """SNAP1: the whole table written under a date-stamped path."""
    path = snapshot_path(base, table, "FULL", stamp)
    df.write.mode("overwrite").parquet(path)
    return path


def differential(full: DataFrame, current: DataFrame, key: str, cols: Sequence[str] | None = None) -> DataFrame:
    """SNAP2: rows of ``current`` changed since ``full``: I(nserted), U(pdated), D(eleted).

    One full outer join by key on (key, row hash); deleted keys carry the old row.
    """
    cols = list(cols or [c for c in current.columns if c != key])
    f = full.select(key, *cols, row_hash(full, cols).alias("_h")).alias("f")
    c = current.select(key, *cols, row_hash(current, cols).alias("_h")).alias("c")
    j = f.join(c, F.col(f"f.{key}") == F.col(f"c.{key}"), "full_outer")
    op = (
        F.when(F.col(f"f.{key}").isNull(), "I")
        .when(F.col(f"c.{key}").isNull(), "D")
        .when(F.col("f._h") != F.col("c._h"), "U")
    )
    side = lambda name: F.when(F.col(f"c.{key}").isNull(), F.col(f"f.{name}")).otherwise(F.col(f"c.{name}"))
    return j.select(op.alias("op"), *[side(x).alias(x) for x in [key, *cols]]).filter(F.col("op").isNotNull())


def restore(full: DataFrame, diff: DataFrame, key: str) -> DataFrame:
    """SNAP3: full snapshot + one differential = the table at the differential's time."""
    cols = [c for c in full.columns]
    kept = full.join(diff.select(key), key, "left_anti")
    return kept.unionByName(diff.filter(F.col("op") != "D").select(*cols))


# ---------------------------------------------------------------- TRK
def first_insert_on(log: DataFrame, table_col: str, ts_col: str, day: str) -> DataFrame:
    """TRK1: first insert time per table on one day."""
    return (
        log.filter(F.to_date(F.col(ts_col)) == F.lit(day).cast("date"))
        .groupBy(F.col(table_col).alias("table_name"))
        .agg(F.min(ts_col).alias("first_insert"))
    )


def missing_tables(expected: DataFrame, tracked: DataFrame) -> DataFrame:
    """TRK2: expected tables with no insert on the day."""
    return expected.join(tracked.select("table_name"), "table_name", "left_anti")


def rebuild_tracking(log: DataFrame, table_col: str, ts_col: str, existing: DataFrame | None = None) -> DataFrame:
    """TRK3: first insert per (table, day) from a log, merged with earlier days by ``least``."""
    fresh = log.groupBy(F.col(table_col).alias("table_name"), F.to_date(F.col(ts_col)).alias("day")).agg(
        F.min(ts_col).alias("first_insert")
    )
    if existing is None:
        return fresh
    both = existing.unionByName(fresh)
    return both.groupBy("table_name", "day").agg(F.min("first_insert").alias("first_insert"))


# ---------------------------------------------------------------- Q
def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q1: key values that occur more than once or are NULL (primary-key violations)."""
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
    return g.filter((F.col("occurrences") > 1) | null_key)


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Q2: child rows whose non-NULL foreign key has no parent row."""
    keys = parent.select(F.col(pk).alias("_pk")).distinct()
    return child.filter(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Q3: one row with the number of NULLs per column."""
    cols = columns or df.columns
    return df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in cols])


def out_of_domain(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """TYP2: rows of a categorical column whose value is outside its declared domain (a small constant list)."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(allowed)))


def add_surrogate_key(df: DataFrame, order: Sequence[str], start_after: DataFrame | int = 0, out: str = "sk") -> DataFrame:
    """Q4: IDENTITY-like key = previous max + row number over a unique ordering.

    Stable across reruns (a window over the data, not partition-dependent ids).
    ``start_after`` is an int or a one-row frame with column ``_last``.
    """
    numbered = global_rank(df, [(c, True) for c in order], "row_number", "_rn")
    if isinstance(start_after, DataFrame):
        numbered = numbered.crossJoin(F.broadcast(start_after))
        base = F.coalesce(F.col("_last"), F.lit(0))
    else:
        base = F.lit(start_after)
    return numbered.withColumn(out, (base + F.col("_rn")).cast("bigint")).drop("_rn", "_last")


# ---------------------------------------------------------------- ENC1
def encrypt_missing(df: DataFrame, plain_col: str, enc_col: str, keys: DataFrame, key_col: str = "__k") -> DataFrame:
    """ENC1: encrypt only rows whose encrypted column is still NULL (key from a one-row frame)."""
    j = df.crossJoin(F.broadcast(keys))
    enc = F.when(F.col(enc_col).isNull(), encrypt_column(F.col(plain_col), F.col(key_col))).otherwise(F.col(enc_col))
    return j.withColumn(enc_col, enc).drop(key_col)
