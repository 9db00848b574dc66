"""Versioned (slowly changing, type 2) tables and incremental loads.

VER1 initial load, VER2 new keys, VER3 compare all columns, VER4 compare only
rows changed since a watermark, VER5 compare a row hash, VER6 change report,
WMK1 watermark state, LOAD1 / LOAD2 incremental append, STM1 change stamp.

A version table is the source columns plus ``valid_from``, ``valid_to``
(timestamps) and ``flag`` (1 = current row), and ``row_hash`` for the hash
method.  Every function is DataFrame -> DataFrame; one full outer join on the
key decides, per key, whether the current row stays, is closed, or is
followed by a new version.  Nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.protect import row_hash
from ..sources.tables import current_hash_scan, rows_for_keys

# Open end of a current version (quirk 9 in SURVEY: one default) and the
# change-report labels of the hash job ("not modified" / "modified").
HIGH_DATE = "9999-12-31 00:00:00"
LABEL_SAME, LABEL_CHANGED = "Non modifié", "Modifié"
VERSION_COLS = ("valid_from", "valid_to", "flag")


def _ts(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp_ntz")


def open_rows(source: DataFrame, as_of: str | Column, high_date: str = HIGH_DATE) -> DataFrame:
    """Source rows as current versions."""
    return source.withColumn("valid_from", _ts(as_of)).withColumn("valid_to", _ts(high_date)).withColumn("flag", F.lit(1))


def initial_load(
    source: DataFrame, as_of: str | Column, high_date: str = HIGH_DATE, hash_cols: Sequence[str] | None = None
) -> DataFrame:
    """VER1: every source row opened (plus its row hash for the hash method)."""
    if hash_cols:
        source = source.withColumn("row_hash", row_hash(source, hash_cols))
    return open_rows(source, as_of, high_date)


def is_empty(df: DataFrame) -> bool:
    """AGG13: emptiness test (reads at most one row)."""
    return df.isEmpty()


def last_max_key(target: DataFrame, key: str) -> DataFrame:
    """AGG12: one-row frame with COALESCE(MAX(key), 0)."""
    return target.agg(F.coalesce(F.max(key), F.lit(0)).alias("_last_max"))


def new_keys_by_max(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """VER2 / SRC2 as the reference does it: source rows above the target's max key."""
    # a scalar subquery: its value reaches the source's scan as a filter
    return source.filter(F.col(key) > last_max_key(target, key).scalar())


def new_keys(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """VER2: source rows whose key the target has never seen (also late, lower keys)."""
    return source.join(target.select(key).distinct(), key, "left_anti")


def incremental_append(target: DataFrame, source: DataFrame, key: str, clean=None) -> DataFrame:
    """LOAD1 + LOAD2: empty target -> whole source, else rows above the max key; cleaned.

    Returns the rows to append.  The emptiness branch is inside the plan (the
    max of an empty target is 0 through COALESCE), so no driver branch is
    needed; key values are assumed > 0 as in the reference.
    """
    rows = new_keys_by_max(target, source, key)
    return clean(rows) if clean else rows


def _differs(cols: Sequence[str], left: str, right: str) -> Column:
    """Any column differs, NULL-safe (two NULLs are equal, quirk 7)."""
    conds = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols]
    out = F.lit(False)
    for c in conds:
        out = out | c
    return out


def _merge(
    target: DataFrame,
    source: DataFrame,
    key: str,
    as_of: str | Column,
    changed: Column,
    data_cols: Sequence[str],
    high_date: str,
    extra_new: dict[str, Column] | None = None,
    source_is_delta: bool = False,
) -> DataFrame:
    """Shared merge: history kept, current rows kept or closed, new versions and new keys opened.

    With ``source_is_delta`` the source holds only changed rows: current rows
    of other keys are passed through by an anti join (the delta's keys can be
    broadcast when small), and only the touched keys meet in the full join.
    """
    extra_new = extra_new or {}
    out_cols = [key, *data_cols, *extra_new.keys(), *VERSION_COLS]
    history = target.filter(F.col("flag") != 1).select(*out_cols)
    current = target.filter(F.col("flag") == 1)
    if source_is_delta:
        delta_keys = source.select(key).distinct()
        history = history.unionByName(current.join(delta_keys, key, "left_anti").select(*out_cols))
        current = rows_for_keys(current, delta_keys, key)
    current = current.alias("t")
    src = source.alias("s")
    j = current.join(src, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    t_present = F.col(f"t.{key}").isNotNull()
    s_present = F.col(f"s.{key}").isNotNull()
    is_changed = t_present & s_present & changed
    now, high = _ts(as_of), _ts(high_date)

    old_row = F.struct(
        F.col(f"t.{key}").alias(key),
        *[F.col(f"t.{c}").alias(c) for c in data_cols],
        *[F.col(f"t.{c}").alias(c) for c in extra_new],
        F.col("t.valid_from").alias("valid_from"),
        F.when(is_changed, now).otherwise(F.col("t.valid_to")).alias("valid_to"),
        F.when(is_changed, F.lit(0)).otherwise(F.col("t.flag")).alias("flag"),
    )
    new_row = F.struct(
        F.col(f"s.{key}").alias(key),
        *[F.col(f"s.{c}").alias(c) for c in data_cols],
        *[expr.alias(name) for name, expr in extra_new.items()],
        now.alias("valid_from"),
        high.alias("valid_to"),
        F.lit(1).alias("flag"),
    )
    rows = F.array(
        F.when(t_present, old_row),
        F.when(s_present & (~t_present | is_changed), new_row),
    )
    merged = j.select(F.explode(rows).alias("r")).filter(F.col("r").isNotNull()).select("r.*")
    return history.unionByName(merged)


def scd2_compare(
    target: DataFrame,
    source: DataFrame,
    key: str,
    as_of: str | Column,
    compare_cols: Sequence[str] | None = None,
    high_date: str = HIGH_DATE,
) -> DataFrame:
    """VER3: compare every non-key column; a difference closes the current row and opens a new one."""
    data_cols = [c for c in source.columns if c != key]
    cols = list(compare_cols) if compare_cols else data_cols
    return _merge(target, source, key, as_of, _differs(cols, "t", "s"), data_cols, high_date)


def scd2_since(
    target: DataFrame,
    source: DataFrame,
    key: str,
    ts_col: str,
    watermark: DataFrame,
    as_of: str | Column,
    high_date: str = HIGH_DATE,
) -> DataFrame:
    """VER4: only source rows stamped after the watermark are compared (without the stamp).

    ``watermark`` is a one-row frame with column ``watermark`` (NULL or
    missing = compare everything).  Current rows of other keys pass through.
    """
    bound = watermark.agg(F.max("watermark").cast("timestamp_ntz").cast("string")).first()[0]  # one value
    recent = source if bound is None else source.filter(F.col(ts_col) > F.lit(bound).cast(dict(source.dtypes)[ts_col]))
    recent = recent.drop(ts_col)
    data_cols = [c for c in recent.columns if c != key]
    return _merge(target, recent, key, as_of, _differs(data_cols, "t", "s"), data_cols, high_date, source_is_delta=True)


def advance_watermark(state: DataFrame, table: str, as_of: str | Column) -> DataFrame:
    """WMK1: the state row of ``table`` set to the run time, also when nothing changed."""
    others = state.filter(F.col("table") != table)
    mine = state.sparkSession.range(1).select(F.lit(table).alias("table"), _ts(as_of).alias("watermark"))
    return others.unionByName(mine)


def read_watermark(state: DataFrame, table: str) -> DataFrame:
    """WMK1 read with default: a one-row frame, NULL when the table has no state yet."""
    return state.filter(F.col("table") == table).agg(F.max("watermark").alias("watermark"))


def scd2_hash(
    target: DataFrame,
    source: DataFrame,
    key: str,
    hash_cols: Sequence[str],
    as_of: str | Column,
    high_date: str = HIGH_DATE,
) -> DataFrame:
    """VER5: compare a row hash of the source with the hash stored on the current row."""
    src = source.withColumn("_new_hash", row_hash(source, hash_cols))
    data_cols = [c for c in source.columns if c != key]
    changed = ~F.col("t.row_hash").eqNullSafe(F.col("s._new_hash"))
    return _merge(target, src, key, as_of, changed, data_cols, high_date, {"row_hash": F.col("s._new_hash")})


def change_report(target: DataFrame, source: DataFrame, key: str, hash_cols: Sequence[str]) -> DataFrame:
    """VER6: key, stored hash, new hash and a label, for keys present on both sides.

    Reads only (key, hash, flag) of the target (SRC4).
    """
    current = current_hash_scan(target, key).select(key, F.col("row_hash").alias("ChecksumColonne"))
    src = source.select(key, row_hash(source, hash_cols).alias("NouveauChecksum"))
    j = src.join(current, key, "inner")
    label = F.when(F.col("NouveauChecksum") == F.col("ChecksumColonne"), F.lit(LABEL_SAME)).otherwise(F.lit(LABEL_CHANGED))
    return j.withColumn("StatutModification", label)


def stamp_changes(old: DataFrame, new: DataFrame, key: str, ts_col: str, as_of: str | Column) -> DataFrame:
    """STM1: set ``ts_col`` to the run time on inserted or changed rows, keep it elsewhere."""
    data_cols = [c for c in new.columns if c not in (key, ts_col)]
    o = old.alias("o")
    n = new.alias("n")
    j = n.join(o, F.col(f"n.{key}") == F.col(f"o.{key}"), "left")
    changed = F.col(f"o.{key}").isNull() | _differs(data_cols, "o", "n")
    return j.select(
        *[F.col(f"n.{c}").alias(c) for c in new.columns if c != ts_col],
        F.when(changed, _ts(as_of)).otherwise(F.col(f"o.{ts_col}")).alias(ts_col),
    )
