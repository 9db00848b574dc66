"""Differences between two states of a table by digests of key ranges (SNAP2, VER3).

A full outer join reads both tables whole, however few rows changed.  Here both are
summed up per key range first (a scan with a small aggregate, no shuffle of rows), the
digests are compared, and only the ranges that differ are joined: their bounds reach the
scan as filters, so Parquet row groups outside are skipped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .loading import differential
from .staging import staged
from .versioning import scd2_compare

Ranges = list[tuple[int, int]]


def range_digests(df: DataFrame, key: str, cols: Sequence[str], low: int, width: int) -> DataFrame:
    """(leaf, rows, mix, total): per key range the number of rows and two sums of row hashes that no order changes."""
    fields = [F.col(key), *(F.col(c) for c in cols), *(F.col(c).isNull() for c in cols)]
    return df.groupBy(F.floor((F.col(key) - F.lit(low)) / F.lit(width)).alias("leaf")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor(F.xxhash64(*fields)).alias("mix"),
        F.sum(F.xxhash64(F.lit(1), *fields).cast("decimal(38,0)")).alias("total"),
    )


def differing_ranges(
    old: DataFrame, new: DataFrame, key: str, cols: Sequence[str], leaves: int = 4096, fan: int = 16, most: int = 64
) -> Ranges:
    """Key ranges (first, last) that hold every difference: at most ``most``.

    The digests are the leaves of a tree: a node's digest sums up those of its ``fan``
    children.  The comparison goes down from the root as long as not more than ``most``
    nodes differ, so equal tables are done at the root, and differences all over the
    table end at a level whose few nodes cover them.  The leaf tables hold ``leaves``
    rows at the most; keys are whole numbers, and NULL keys are not compared.
    """
    bounds = [df.agg(F.min(key), F.max(key)).first() for df in (old, new)]
    lows, highs = ([b[i] for b in bounds if b[i] is not None] for i in (0, 1))
    if not lows:
        return []
    low, high = min(lows), max(highs)
    width = max(1, -(-(high - low + 1) // leaves))
    sides = [staged(range_digests(df.filter(F.col(key).isNotNull()), key, cols, low, width), "digests") for df in (old, new)]
    levels, span = [], 1
    while span < leaves:
        levels.append(span)
        span *= fan
    nodes, found = None, None
    for span in reversed([*levels, span]):
        a, b = (_level(s, span, fan, nodes, names) for s, names in zip(sides, (("ar", "am", "at"), ("br", "bm", "bt")), strict=True))
        same = F.col("ar").eqNullSafe(F.col("br")) & F.col("am").eqNullSafe(F.col("bm")) & F.col("at").eqNullSafe(F.col("bt"))
        differ = sorted(r["node"] for r in a.join(b, "node", "full_outer").filter(~same).select("node").limit(most + 1).collect())
        if not differ:
            return []
        if len(differ) > most:
            break
        nodes, found = differ, span
    if found is None:
        return [(low, high)]
    return _merged([(low + n * found * width, low + (n + 1) * found * width - 1) for n in nodes])


def _level(leaves: DataFrame, span: int, fan: int, parents: list[int] | None, names: Sequence[str]) -> DataFrame:
    """Digests of the nodes of ``span`` leaves each, of the children of ``parents`` only."""
    node = F.floor(F.col("leaf") / F.lit(span))
    if parents is not None:
        leaves = leaves.filter(F.floor(F.col("leaf") / F.lit(span * fan)).isin(parents))
    sums = (F.sum("rows"), F.bit_xor("mix"), F.sum("total"))
    return leaves.groupBy(node.alias("node")).agg(*[s.alias(n) for s, n in zip(sums, names, strict=True)])


def _merged(ranges: Ranges) -> Ranges:
    out: Ranges = []
    for first, last in ranges:
        if out and out[-1][1] + 1 == first:
            out[-1] = (out[-1][0], last)
        else:
            out.append((first, last))
    return out


def inside(key: str, ranges: Ranges) -> Column:
    """The rows of the ranges; comparisons with constants, which the scan takes over."""
    hit = F.lit(False)
    for first, last in ranges:
        hit = hit | ((F.col(key) >= F.lit(first)) & (F.col(key) <= F.lit(last)))
    return hit


def differential_by_range(full: DataFrame, current: DataFrame, key: str, cols: Sequence[str] | None = None, **tree) -> DataFrame:
    """SNAP2 as ``loading.differential``; only key ranges whose digests differ are joined."""
    cols = list(cols or [c for c in current.columns if c != key])
    hit = inside(key, differing_ranges(full, current, key, cols, **tree))
    return differential(full.filter(hit), current.filter(hit), key, cols)


def scd2_compare_by_range(target: DataFrame, source: DataFrame, key: str, as_of: str | Column, **tree) -> DataFrame:
    """VER3 as ``versioning.scd2_compare``; versions outside the differing key ranges pass through unread by the join."""
    cols = [c for c in source.columns if c != key]
    open_ = target.filter(F.col("flag") == 1).select(key, *cols)
    hit = inside(key, differing_ranges(open_, source, key, cols, **tree))
    merged = scd2_compare(target.filter(hit), source.filter(hit), key, as_of)
    return merged.unionByName(target.filter(~hit | F.col(key).isNull()).select(*merged.columns))
