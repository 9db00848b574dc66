"""Windows over a whole table without pulling it into one task (WIN1, WIN3, WIN4, WIN6).

``Window.orderBy(...)`` without ``partitionBy`` makes Spark move every row into a
single task.  These helpers give the same numbers with range partitioning:

1. aggregate the ordering values first (a hot value collapses to one row),
2. range-partition the distinct values and write them once with their partition
   number (``sliced``): two branches of a plan that each range-partitioned the
   frame would sample bounds of their own, and their slices would differ,
3. number the values inside each slice and add per-slice offsets computed from a
   frame with one row per slice (bounded by their count, so broadcasting is safe),
4. join the numbers back on the ordering values.

All numbers are bigint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

Order = Sequence[tuple[str, bool]]  # (column, ascending)


def _sort_exprs(order: Order) -> list[Column]:
    # ANSI / DuckDB / Spark default: NULLs first ascending, last descending.
    return [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in order]


def _partitions(df: DataFrame, n_parts: int | None) -> int:
    if n_parts:
        return n_parts
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def materialize(df: DataFrame) -> DataFrame:
    """Write an intermediate frame once to the shared checkpoint folder and read it back.

    For frames that several branches of one plan read: Spark cannot reuse a
    shuffle when the branches prune different columns, so without this the
    joins below would run once per branch.  A reliable checkpoint also cuts
    the lineage, so a lost executor does not recompute the whole chain.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sliced(df: DataFrame, sort: Sequence[Column], n: int) -> DataFrame:
    """``df`` cut into ``n`` ordered slices, numbered in ``_pid``, written once: every reader sees the same slices."""
    return materialize(df.repartitionByRange(n, *sort).withColumn("_pid", F.spark_partition_id()))


def _numbering(df: DataFrame, order: Order, kind: str, out: str, n: int) -> DataFrame:
    """Distinct ordering values of ``df`` with their global rank (``_k<i>`` key columns, ``out``)."""
    keys = [c for c, _ in order]
    sort = _sort_exprs(order)
    distinct = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt"))
    ranged = sliced(distinct, sort, n)
    w = Window.partitionBy("_pid").orderBy(*sort)
    ranged = ranged.withColumn(
        "_rows_before", F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).withColumn("_vals_before", F.row_number().over(w) - 1)
    per_part = ranged.groupBy("_pid").agg(F.sum("_cnt").alias("_pn"), F.count(F.lit(1)).alias("_pd"))
    wp = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        "_pid",
        F.coalesce(F.sum("_pn").over(wp), F.lit(0)).alias("_off"),
        F.coalesce(F.sum("_pd").over(wp), F.lit(0)).alias("_doff"),
    )
    # one row per slice: bounded by n, broadcast is safe
    numbered = ranged.join(F.broadcast(offsets), "_pid")
    if kind in ("rank", "row_number"):
        value = F.col("_off") + F.col("_rows_before") + 1
    elif kind == "dense_rank":
        value = F.col("_doff") + F.col("_vals_before") + 1
    else:
        raise ValueError(kind)
    return numbered.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], value.cast("long").alias(out))


def global_ranks(
    df: DataFrame, specs: Sequence[tuple[Order, str, str]], n_parts: int | None = None, materialize_input: bool = False
) -> DataFrame:
    """Several global rankings of the same frame: ``specs`` = [(order, kind, out), ...].

    Each ranking is computed from the distinct ordering values only and joined
    back on them (NULL-safe), so ``df`` is joined once per ranking and never
    sorted as a whole.  ``row_number`` needs a unique ordering (append the
    key); it then equals ``rank``.  ``materialize_input`` checkpoints ``df``
    first when it is an expensive plan (it is read 1 + len(specs) times).
    """
    n = _partitions(df, n_parts)
    if materialize_input:
        df = materialize(df)
    out = df
    for order, kind, name in specs:
        numbered = _numbering(df, order, kind, name, n)
        keys = [c for c, _ in order]
        cond = [out[k].eqNullSafe(numbered[f"_k{i}"]) for i, k in enumerate(keys)]
        out = out.join(numbered, cond, "inner").drop(*[f"_k{i}" for i in range(len(keys))])
    return out


def global_rank(
    df: DataFrame,
    order: Order,
    kind: str = "rank",
    out: str = "rank",
    n_parts: int | None = None,
    materialize_input: bool = False,
) -> DataFrame:
    """Add ``rank`` / ``dense_rank`` / ``row_number`` over the whole frame (see ``global_ranks``)."""
    return global_ranks(df, [(order, kind, out)], n_parts, materialize_input)


def global_lag_lead(
    df: DataFrame,
    order: Order,
    columns: Sequence[str],
    n_parts: int | None = None,
    row_number: str | None = None,
) -> DataFrame:
    """Add ``prev_<c>`` / ``next_<c>`` (LAG / LEAD by one row) over a unique ordering.

    Rows are split into ordered slices (``sliced``); inside a slice the
    ordinary window gives the neighbours, and the first / last row of each
    slice takes its neighbour from the adjacent non-empty slice.
    """
    sort = _sort_exprs(order)
    n = _partitions(df, n_parts)
    ranged = sliced(df, sort, n)
    w = Window.partitionBy("_pid").orderBy(*sort)
    ranged = ranged.withColumn("_rn", F.row_number().over(w)).withColumn("_cnt", F.count(F.lit(1)).over(Window.partitionBy("_pid")))
    for c in columns:
        ranged = ranged.withColumn(f"_lag_{c}", F.lag(c).over(w)).withColumn(f"_lead_{c}", F.lead(c).over(w))
    order_struct = F.struct(*[F.col(c) for c, _ in order])
    edge_aggs = [F.count(F.lit(1)).alias("_pn")]
    for c in columns:
        edge_aggs.append(F.min_by(F.col(c), order_struct).alias(f"_first_{c}"))
        edge_aggs.append(F.max_by(F.col(c), order_struct).alias(f"_last_{c}"))
    edges = ranged.groupBy("_pid").agg(*edge_aggs)
    wp = Window.orderBy("_pid")
    edge_cols = [F.col("_pid"), F.coalesce(F.sum("_pn").over(wp.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off")]
    for c in columns:
        edge_cols.append(F.lag(f"_last_{c}").over(wp).alias(f"_prev_last_{c}"))
        edge_cols.append(F.lead(f"_first_{c}").over(wp).alias(f"_next_first_{c}"))
    # one row per range partition: bounded by n, broadcast is safe
    out = ranged.join(F.broadcast(edges.select(*edge_cols)), "_pid")
    for c in columns:
        out = out.withColumn(
            f"prev_{c}", F.when(F.col("_rn") == 1, F.col(f"_prev_last_{c}")).otherwise(F.col(f"_lag_{c}"))
        ).withColumn(f"next_{c}", F.when(F.col("_rn") == F.col("_cnt"), F.col(f"_next_first_{c}")).otherwise(F.col(f"_lead_{c}")))
    if row_number:
        out = out.withColumn(row_number, (F.col("_off") + F.col("_rn")).cast("long"))
    drop = [c for c in out.columns if c.startswith("_")]
    return out.drop(*drop)


def share_of_total(df: DataFrame, value: str, out: str, scale: float = 100.0) -> DataFrame:
    """WIN10: value / SUM(value) OVER () * scale with a one-row total (broadcast, exactly one row)."""
    total = df.agg(F.sum(value).alias("_total"))
    return df.crossJoin(F.broadcast(total)).withColumn(
        out, F.try_divide(F.col(value).cast("double"), F.col("_total")) * scale
    ).drop("_total")


def min_max_normalise(df: DataFrame, value: str, out: str) -> DataFrame:
    """WIN15: (x - min) / (max - min) with the global min / max as a one-row frame."""
    stats = df.agg(F.min(value).alias("_mn"), F.max(value).alias("_mx"))
    return df.crossJoin(F.broadcast(stats)).withColumn(
        out, F.try_divide((F.col(value) - F.col("_mn")).cast("double"), F.col("_mx") - F.col("_mn"))
    ).drop("_mn", "_mx")


def partitioned_numbering(
    df: DataFrame,
    part: Sequence[str],
    order: Order,
    tie_key: str,
    n_parts: int | None = None,
) -> DataFrame:
    """ROW_NUMBER / RANK / DENSE_RANK / COUNT per group of ``part`` without one task per group.

    ``Window.partitionBy(part)`` runs each group in one task: a low-cardinality
    key (25 departments) uses 25 tasks whatever the cluster size, and a hot
    group lands whole in one of them.  Here rows are range-partitioned on
    (part, order, tie_key) and written once (``sliced``), so a big group spans many
    slices, and so does a value that most rows of a group share; each slice numbers its
    rows, and counts per (slice, group) turn into offsets.  A slice may begin with the
    value that the one before ends with: those rows take the rank of the value's first
    row, and the value counts once for the dense rank.  Adds ``_rn`` (row number, ties
    broken by ``tie_key``), ``_rank``, ``_dense`` and ``_gcount`` (rows in the group).
    """
    n = _partitions(df, n_parts)
    by_value = _sort_exprs(order)
    ranged = sliced(df, [F.col(p).asc_nulls_first() for p in part] + by_value + [F.col(tie_key).asc_nulls_first()], n)
    local = Window.partitionBy("_pid", *part).orderBy(*by_value, F.col(tie_key).asc_nulls_first())
    local_peers = Window.partitionBy("_pid", *part).orderBy(*by_value)
    ranged = (
        ranged.withColumn("_lrn", F.row_number().over(local))
        .withColumn("_lrank", F.rank().over(local_peers))
        .withColumn("_ldense", F.dense_rank().over(local_peers))
    )
    value = F.struct(*[F.col(c) for c, _ in order])
    stats = ranged.groupBy("_pid", *part).agg(
        F.count(F.lit(1)).alias("_n"), F.max("_ldense").alias("_d"),
        F.min_by(value, "_lrn").alias("_first"), F.max_by(value, "_lrn").alias("_last"), F.max("_lrank").alias("_last_rank"),
    )
    in_order = Window.partitionBy(*part).orderBy("_pid")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*part)
    placed = stats.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn(
        "_goes_on", F.coalesce(F.lag("_last").over(in_order).eqNullSafe(F.col("_first")) & (F.col("_off") > 0), F.lit(False))
    )
    # where the value that a slice ends with begins: in the slice, or where its first value does
    starts = placed.withColumn("_own", F.when((F.col("_d") > 1) | ~F.col("_goes_on"), F.col("_off") + F.col("_last_rank")))
    offsets = starts.select(
        "_pid", *[F.col(p).alias(f"_p_{p}") for p in part], "_off", "_goes_on",
        F.last("_own", ignorenulls=True).over(before).alias("_tie_start"),
        (F.coalesce(F.sum("_d").over(before), F.lit(0)) - F.sum(F.col("_goes_on").cast("long")).over(in_order.rowsBetween(Window.unboundedPreceding, 0))).alias("_doff"),
        F.sum("_n").over(whole).alias("_gcount"),
    )
    cond = [ranged["_pid"] == offsets["_pid"]] + [ranged[p].eqNullSafe(offsets[f"_p_{p}"]) for p in part]
    j = ranged.join(offsets, cond).drop(offsets["_pid"])
    tied = F.col("_goes_on") & (F.col("_lrank") == 1)
    return j.select(
        *df.columns,
        (F.col("_off") + F.col("_lrn")).cast("long").alias("_rn"),
        F.when(tied, F.col("_tie_start")).otherwise(F.col("_off") + F.col("_lrank")).cast("long").alias("_rank"),
        (F.col("_doff") + F.col("_ldense")).cast("long").alias("_dense"),
        F.col("_gcount"),
    )


def running_best(df: DataFrame, part: Sequence[str], order: Order, value: str, n_parts: int | None = None) -> DataFrame:
    """Running minima of ``value`` per group: ``_from_left`` up to each row, ``_from_right`` from it on.

    A window over ``part`` alone would run a big group in one task.  Rows are
    range-partitioned on (part, order) and written once (``sliced``); each slice runs on
    its own, and takes over the least value of its group in the slices before / after,
    from one row per (slice, group).
    """
    n = _partitions(df, n_parts)
    sort = [F.col(p).asc_nulls_first() for p in part] + _sort_exprs(order)
    ranged = sliced(df, sort, n)
    local = Window.partitionBy("_pid", *part).orderBy(*_sort_exprs(order))
    left, right = local.rowsBetween(Window.unboundedPreceding, 0), local.rowsBetween(0, Window.unboundedFollowing)
    run = ranged.withColumn("_l", F.min(value).over(left)).withColumn("_r", F.min(value).over(right))
    per = ranged.groupBy("_pid", *part).agg(F.min(value).alias("_least"))
    whole = Window.partitionBy(*part).orderBy("_pid")
    carried = per.select(
        F.col("_pid").alias("_of"), *[F.col(p).alias(f"_p_{p}") for p in part],
        F.min("_least").over(whole.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.min("_least").over(whole.rowsBetween(1, Window.unboundedFollowing)).alias("_after"),
    )
    cond = [ranged["_pid"] == carried["_of"]] + [ranged[p].eqNullSafe(carried[f"_p_{p}"]) for p in part]
    joined = run.join(carried, cond)
    # least() skips nulls
    return joined.select(*df.columns, F.least("_l", "_before").alias("_from_left"), F.least("_r", "_after").alias("_from_right"))


def running_sum(df: DataFrame, part: Sequence[str], order: Order, value: str, out: str, n_parts: int | None = None) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows of its group before it, by a unique order; sliced as ``running_best``."""
    n = _partitions(df, n_parts)
    ranged = sliced(df, [F.col(p).asc_nulls_first() for p in part] + _sort_exprs(order), n)
    local = Window.partitionBy("_pid", *part).orderBy(*_sort_exprs(order)).rowsBetween(Window.unboundedPreceding, -1)
    run = ranged.withColumn("_here", F.coalesce(F.sum(value).over(local), F.lit(0)))
    per = ranged.groupBy("_pid", *part).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*part).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = per.select(
        F.col("_pid").alias("_of"), *[F.col(p).alias(f"_p_{p}") for p in part], F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before")
    )
    cond = [ranged["_pid"] == carried["_of"]] + [ranged[p].eqNullSafe(carried[f"_p_{p}"]) for p in part]
    return run.join(carried, cond).select(*df.columns, (F.col("_before") + F.col("_here")).alias(out))


def ntile_from_row_number(rn: Column, count: Column, buckets: int) -> Column:
    """NTILE(buckets) from a row number and the group size (the first count % buckets tiles get one extra row)."""
    q = F.floor(count / buckets)
    r = count - q * buckets
    big = r * (q + 1)
    return F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1).otherwise(r + F.floor((rn - big - 1) / q) + 1).cast("long")
