"""Join operators Spark has no single call for (JN5, JN7, JN8, JN12, SRT4-SRT6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import staged
from .windows import running_best


def null_aware_anti(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """JN7: ``left WHERE left_key NOT IN (SELECT right_key FROM right)`` with SQL NULL rules.

    An empty subquery keeps every row (NULL keys too); a NULL inside the
    subquery removes every row; otherwise rows whose key is NULL go away.
    The statistics frame has exactly one row.
    """
    stats = right.agg(
        F.count(F.lit(1)).alias("_n_all"),
        F.count(F.when(F.col(right_key).isNull(), 1)).alias("_n_null"),
    )
    keys = right.filter(F.col(right_key).isNotNull()).select(F.col(right_key).alias("_rk")).distinct()
    kept = left.join(keys, left[left_key] == keys["_rk"], "left_anti")
    kept = kept.crossJoin(F.broadcast(stats)).filter(
        (F.col("_n_all") == 0) | ((F.col("_n_null") == 0) & F.col(left_key).isNotNull())
    )
    return kept.drop("_n_all", "_n_null")


def lookup_route(records: DataFrame, target: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """JN12: split incoming records into (matched, unmatched) by key presence in the target."""
    keys = target.select(key).distinct()
    return records.join(keys, key, "left_semi"), records.join(keys, key, "left_anti")


def fan_out_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_spread: Column,
    right_spread: Column,
    cell: int = 4096,
    left_keys: DataFrame | None = None,
) -> DataFrame:
    """JN5: ``left LEFT JOIN right ON left_key = right_key`` where a key may hold many rows of both sides.

    Rows are counted per key first.  A key with more than ``cell`` rows on a side is cut
    into a grid: its left rows into ``ceil(left / cell)`` parts, its right rows into
    ``ceil(right / cell)``, by hashes of ``left_spread`` / ``right_spread``.  Each left row
    goes to all right parts and the other way round, so every pair meets in one grid cell,
    no cell holds much more than ``cell`` rows of a side, and rows are repeated only in
    heavy keys, once per ``cell`` rows of the other side.  Other keys are joined as they
    are.  A left row without a match stays once; rows with a NULL key are spread, as they
    match nothing.

    ``left_keys`` may name a cheaper frame with the left keys to count (at least as many
    rows per key).  Key names must differ; columns that begin with ``_fan_`` are taken.
    """
    counted = (left if left_keys is None else left_keys).filter(F.col(left_key).isNotNull())
    n_left = counted.groupBy(F.col(left_key).alias("_fan_key")).agg(F.count(F.lit(1)).alias("_fan_nl"))
    n_right = right.filter(F.col(right_key).isNotNull()).groupBy(F.col(right_key).alias("_fan_key")).agg(F.count(F.lit(1)).alias("_fan_nr"))
    parts = n_left.join(n_right, "_fan_key").select(
        "_fan_key", F.ceil(F.col("_fan_nl") / cell).alias("_fan_l"), F.ceil(F.col("_fan_nr") / cell).alias("_fan_r")
    )
    heavy = staged(parts.filter("_fan_l > 1 OR _fan_r > 1"), "heavy-keys")
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")

    def sized(df: DataFrame, key: str) -> DataFrame:
        return df.join(heavy, df[key] == heavy["_fan_key"], "left")

    def dealt(df: DataFrame, spread: Column, own: str, other: str, own_cell: str, other_cell: str) -> DataFrame:
        own_cell_of = F.pmod(spread, F.coalesce(own, one))
        every = F.explode(F.sequence(zero, F.coalesce(F.col(other), one) - 1))
        return df.withColumn(own_cell, own_cell_of).withColumn(other_cell, every)

    lefts = dealt(sized(left, left_key), left_spread, "_fan_l", "_fan_r", "_fan_i", "_fan_j").withColumn(
        "_fan_i", F.when(F.col(left_key).isNull(), F.pmod(left_spread, F.lit(1 << 20))).otherwise(F.col("_fan_i"))
    ).withColumn("_fan_heavy", F.col("_fan_key").isNotNull()).drop("_fan_key", "_fan_l", "_fan_r")
    rights = dealt(sized(right, right_key), right_spread, "_fan_r", "_fan_l", "_fan_rj", "_fan_ri").withColumn("_fan_hit", F.lit(True))
    rights = rights.filter(F.col(right_key).isNotNull()).drop("_fan_key", "_fan_l", "_fan_r")
    joined = lefts.join(
        rights, (F.col(left_key) == F.col(right_key)) & (F.col("_fan_i") == F.col("_fan_ri")) & (F.col("_fan_j") == F.col("_fan_rj")), "left"
    )
    # a heavy key has matches, but a part of its right rows may be empty
    kept = joined.filter(F.col("_fan_hit") | ~F.col("_fan_heavy"))
    return kept.drop("_fan_i", "_fan_j", "_fan_ri", "_fan_rj", "_fan_heavy", "_fan_hit")


def _rank_fields(df: DataFrame, best: Sequence[tuple[str, bool]]) -> list[Column] | None:
    """Fields whose struct orders rows best first, or None where a column can't be negated."""
    fields, types = [], dict(df.dtypes)
    for i, (name, asc) in enumerate(best):
        if not asc and not types[name].startswith(("int", "bigint", "double", "float", "decimal", "smallint", "tinyint")):
            return None
        value = F.col(name) if asc else -F.col(name)
        fields += [F.col(name).isNull().alias(f"n{i}"), value.alias(f"v{i}")]
    return fields


def range_top1(
    outer: DataFrame,
    outer_value: str,
    inner: DataFrame,
    inner_value: str,
    low: float,
    high: float,
    best: Sequence[tuple[str, bool]],
    n_parts: int | None = None,
) -> DataFrame:
    """JN8: for each outer row the best inner row with ``inner_value BETWEEN outer_value + low AND outer_value + high``.

    No pair is formed.  The inner side is reduced to its best row per distinct value, the
    outer side to its distinct values.  Values are cut into bands half as wide as the
    range, so a range begins in one band, ends in a later one and holds the bands between,
    two at the most.  Its best row is the best of what follows its low end in the first
    band (a running best from the right), of what precedes its high end in the last (a
    running best from the left), and of the whole bands between.  Both running bests come
    from one sorted sequence of inner values and range ends (``windows.running_best``):
    rows are inner values + 2 x outer values, and a band with most of the values is spread
    over the slices of the sort.

    Outer rows without a match are dropped (CROSS APPLY).  ``best`` must end with a unique
    key; a descending column must be a number.  Values are compared as doubles.
    """
    payload = [c for c in inner.columns if c != inner_value]
    order = _rank_fields(inner, best)
    if order is None:
        raise TypeError("a descending column must be a number")
    row = F.struct(*order, F.struct(*payload).alias("row")).alias("_best")
    values = (
        inner.filter(F.col(inner_value).isNotNull())
        .select((F.col(inner_value).cast("double") + F.lit(0.0)).alias("_at"), row)
        .groupBy("_at").agg(F.min("_best").alias("_best"))
    )
    probes = outer.filter(F.col(outer_value).isNotNull()).select(F.col(outer_value).alias("_probe")).distinct().select(
        "_probe", (F.col("_probe") + F.lit(float(low))).alias("_low"), (F.col("_probe") + F.lit(float(high))).alias("_high")
    )
    if float(high) == float(low):
        found = probes.join(values, F.col("_low") == F.col("_at")).select("_probe", "_best")
    else:
        found = _banded_best(values, probes, (float(high) - float(low)) / 2, n_parts)
    won = found.select("_probe", *[F.col(f"_best.row.{c}").alias(c) for c in payload])
    return outer.join(won, outer[outer_value] == won["_probe"]).drop("_probe")


def _banded_best(values: DataFrame, probes: DataFrame, width: float, n_parts: int | None) -> DataFrame:
    """(_probe, _best): the least ``_best`` of the values from ``_low`` to ``_high``."""
    band = lambda c: F.floor(F.col(c) / F.lit(width))
    none, type_ = F.lit(None), dict(values.dtypes)["_best"]
    # a low end comes before equal values, a high end after them
    low_ends = probes.select(band("_low").alias("_band"), F.col("_low").alias("_at"), F.lit(-1).alias("_kind"), "_probe", none.cast(type_).alias("_best"))
    held = values.select(band("_at").alias("_band"), "_at", F.lit(0).alias("_kind"), none.cast("double").alias("_probe"), "_best")
    high_ends = probes.select(band("_high").alias("_band"), F.col("_high").alias("_at"), F.lit(1).alias("_kind"), "_probe", none.cast(type_).alias("_best"))
    sequence = low_ends.unionByName(held).unionByName(high_ends)
    run = running_best(sequence, ["_band"], [("_at", True), ("_kind", True)], "_best", n_parts)
    ends = run.filter("_kind != 0").select("_probe", F.when(F.col("_kind") < 0, F.col("_from_right")).otherwise(F.col("_from_left")).alias("_best"))
    per_band = held.groupBy("_band").agg(F.min("_best").alias("_best"))
    between = probes.select("_probe", (band("_low") + 1).alias("_first"), (band("_high") - 1).alias("_last")).filter("_first <= _last")
    whole = between.select("_probe", F.explode(F.sequence("_first", "_last")).alias("_band")).join(per_band, "_band").select("_probe", "_best")
    return ends.unionByName(whole).groupBy("_probe").agg(F.min("_best").alias("_best")).filter(F.col("_best").isNotNull())


def latest_by(df: DataFrame, key: str, value: str, order_col: str, out: str) -> DataFrame:
    """SRT4: per key the value of the row with the highest ``order_col`` (TOP 1 ... ORDER BY DESC)."""
    return df.groupBy(key).agg(F.max_by(F.col(value), F.col(order_col)).alias(out))


def any_one(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """SRT5: TOP 1 without ORDER BY made deterministic: the smallest value."""
    return df.groupBy(key).agg(F.min(value).alias(out))


def top_keys_by_count(df: DataFrame, key: str, k: int) -> DataFrame:
    """SRT6: the k keys with the most rows (ties by key); a k-row frame."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.col("_n").desc(), F.col(key).asc()).limit(k).select(key)
