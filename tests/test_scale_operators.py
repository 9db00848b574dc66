"""Joins, recursions and windows whose hard case is one group that holds most rows."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.operators import lake
from strata.operators.hierarchy import resolve
from strata.operators.joins import fan_out_join, range_top1


def multiset(df) -> Counter:
    return Counter(map(tuple, df.collect()))


# ------------------------------------------------------------ JN5: fan-out with heavy keys
@pytest.mark.parametrize("cell", [1, 7, 10_000])
def test_fan_out_join_equals_left_join(spark, cell):
    rng = random.Random(cell)
    keys = [None, 1, 1, 1, 1, 1, 2, 3, 4, 5, 6]
    left = spark.createDataFrame([(i, rng.choice(keys)) for i in range(150)], "lid long, lk long")
    right = spark.createDataFrame([(i, rng.choice([k for k in keys if k != 4])) for i in range(60)], "rid long, rk long")
    got = fan_out_join(left, right, "lk", "rk", F.xxhash64("lid"), F.xxhash64("rid"), cell)
    want = left.join(right, F.col("lk") == F.col("rk"), "left")
    assert got.columns == want.columns and multiset(got) == multiset(want)


def test_fan_out_join_spreads_a_heavy_key(spark):
    """A key with 30 % of both sides: no task joins much more than its share of the pairs."""
    n = 6000
    left = spark.range(n).select(F.col("id").alias("lid"), F.when(F.col("id") % 10 < 3, F.lit(-1)).otherwise(F.col("id")).alias("lk"))
    right = spark.range(n).select(F.col("id").alias("rid"), F.when(F.col("id") % 10 < 3, F.lit(-1)).otherwise(F.col("id")).alias("rk"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        per_task = lambda df: [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        split = per_task(fan_out_join(left, right, "lk", "rk", F.xxhash64("lid"), F.xxhash64("rid"), 200))
        plain = per_task(left.join(right, F.col("lk") == F.col("rk"), "left"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(split) == sum(plain) and len(split) == 8
    assert max(plain) > 0.95 * sum(plain) and max(split) < 2 * sum(split) / 8


def test_lake_report_reads_csv_and_survives_bad_keys(spark, tmp_dir):
    rows = {
        "trx": ([("1", "2024-01-01", "10", "5.50", None, "7"), ("2", "2024-01-02", "x", "6.0", "1.0", "7"), ("3", None, "10", None, "1", "7"),
                 ("4", "d", "10", "1", "", "8"), ("5", "d, with comma", "10", "2", "0", "bad")], lake.COLUMNS["trx"]),
        "product": ([("10", 'a "quoted" name')], lake.COLUMNS["product"]),
        "shop": ([("7", "seven", "1"), ("8", None, "1"), ("9", "nine", "2")], lake.COLUMNS["shop"]),
        "city": ([("1", "one"), ("oops", "none")], lake.COLUMNS["city"]),
        "facturation": ([("100", "7", "f1", "1", "3"), ("101", "7", "f2", "1", "4"), ("102", None, "f3", "1", "5")], lake.COLUMNS["facturation"]),
    }
    frames = {n: spark.createDataFrame(r, ", ".join(f"{c} string" for c in cols)) for n, (r, cols) in rows.items()}
    lake.store_tables(frames, tmp_dir)
    files = spark.read.text(f"{tmp_dir}/trx")
    assert not files.filter(F.col("value").contains("nid")).count() and files.count() == 5
    got = multiset(lake.transaction_report(lake.open_tables(spark, tmp_dir), cell=1))
    assert got == Counter({
        ("1", "2024-01-01", "5.50", None, 'a "quoted" name', "seven", "one", amount, day): 1 for amount, day in (("3", "f1"), ("4", "f2"))
    } | {("2", "2024-01-02", "6.0", "1.0", None, "seven", "one", amount, day): 1 for amount, day in (("3", "f1"), ("4", "f2"))})


# ------------------------------------------------------------ JN8: best row of a range
@pytest.mark.parametrize(("low", "high", "parts"), [(-5.0, 5.0, 8), (0.0, 3.0, 3), (-2.5, -1.0, 1), (0.0, 0.0, 8), (-1000.0, 1000.0, 8)])
def test_range_top1_equals_all_pairs(spark, low, high, parts):
    rng = random.Random(int(high))
    inner = [(j, None if j % 17 == 0 else rng.choice([rng.uniform(-30, 30), rng.randint(-9, 9) / 2, -0.0]), rng.choice([None, 0, 1, 2])) for j in range(400)]
    outer = [(i, None if i % 11 == 0 else rng.choice([rng.uniform(-40, 40), rng.randint(-9, 9) / 2])) for i in range(150)] + [(7, 0.0)]
    best = [("total", False), ("sid", True)]
    got = range_top1(spark.createDataFrame(outer, "oid long, x double"), "x", spark.createDataFrame(inner, "sid long, y double, total long"), "y", low, high, best, parts)
    want = Counter()
    for oid, x in outer:
        found = [r for r in inner if x is not None and r[1] is not None and x + low <= r[1] <= x + high]
        if found:
            sid, _, total = min(found, key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
            want[oid, x, sid, total] += 1
    assert multiset(got.select("oid", "x", "sid", "total")) == want


def test_range_top1_of_many_values_in_one_band(spark):
    """100,000 different values inside one range: no join makes more rows than both sides have."""
    n = 100_000
    inner = spark.range(n).select(F.col("id").alias("sid"), (F.col("id") / n).alias("y"), ((F.col("id") * 7919) % n).alias("total"))
    outer = spark.range(2000).select(F.col("id").alias("oid"), (F.col("id") / 2000).alias("x"))
    got = range_top1(outer, "x", inner, "y", -0.5, 0.5, [("total", False), ("sid", True)])
    import numpy as np

    totals, ys = (np.arange(n) * 7919) % n, np.arange(n) / n
    found = {r["oid"]: r["sid"] for r in got.collect()}
    assert len(found) == 2000
    for oid in range(0, 2000, 97):
        x = oid / 2000
        inside = np.flatnonzero((ys >= x - 0.5) & (ys <= x + 0.5))
        assert found[oid] == inside[np.argmax(totals[inside])]


# ------------------------------------------------------------ SUB7: recursion by pointer doubling
def _edges(spark, pairs):
    return spark.createDataFrame([(n, f"n{n}", p) for n, p in pairs], "node long, label string, parent long")


def test_resolve_equals_recursion(spark):
    rng = random.Random(3)
    parents = {n: rng.randint(max(0, n - 40), n - 1) for n in range(3, 200)}
    pairs = [*parents.items(), (150, 2), (500, 501), (502, 502), (503, None), (504, 1)]  # 150 has two parents, 501 has none
    anchors = spark.createDataFrame([(n, f"n{n}") for n in (0, 1, 2)], "node long, label string")
    below: dict = {}
    for n, p in pairs:
        if p is not None and n != p:
            below.setdefault(p, []).append(n)
    want, todo = Counter(), [(n, f"n{n}"[:40], 0) for n in (0, 1, 2)]
    while todo:
        n, path, level = todo.pop()
        want[n, path, level] += 1
        todo += [(c, f"{path} > n{c}"[:40], level + 1) for c in below.get(n, [])]
    assert multiset(resolve(anchors, _edges(spark, pairs), limit=40)) == want


def test_resolve_long_chain_takes_few_rounds(spark, monkeypatch):
    from strata.operators import hierarchy

    rounds = []
    monkeypatch.setattr(hierarchy, "staged", lambda df, tag, f=hierarchy.staged: rounds.append(tag) or f(df, tag))
    chain = spark.range(1, 5001).select(F.col("id").alias("node"), F.col("id").cast("string").alias("label"), (F.col("id") - 1).alias("parent"))
    out = resolve(spark.createDataFrame([(0, "0")], "node long, label string"), chain, limit=30)
    assert len(rounds) <= 15
    assert out.count() == 5001 and out.filter("node = level").count() == 5001
    assert out.filter("node = 4000").first()["path"] == " > ".join(map(str, range(20)))[:30]


@pytest.mark.parametrize("length", [2, 3, 7])
def test_resolve_names_the_nodes_of_a_cycle(spark, length):
    ring = [(10 + i, 10 + (i + 1) % length) for i in range(length)]
    anchors = spark.createDataFrame([(0, "top")], "node long, label string")
    with pytest.raises(RecursionError) as raised:
        resolve(anchors, _edges(spark, [(1, 0), (2, 1), *ring, (99, 10)]))
    assert all(str(10 + i) in str(raised.value) for i in range(length)) and "99" not in str(raised.value)


# ------------------------------------------------------------ WIN4 / WIN5: ties larger than a slice
@pytest.mark.parametrize("parts", [1, 3, 16])
def test_ranks_with_ties_over_slices_equal_windows(spark, parts):
    from pyspark.sql import Window

    from strata.operators.windows import partitioned_numbering

    df = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 7 == 0, None).otherwise(F.when(F.col("id") % 5 == 0, F.lit(2)).otherwise(F.lit(1))).alias("g"),
        F.when(F.col("id") % 2 == 0, F.lit(5.0)).when(F.col("id") % 11 == 0, None).otherwise((F.col("id") % 13).cast("double")).alias("v"),
    )
    got = partitioned_numbering(df, ["g"], [("v", False)], "id", parts)
    w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    want = df.select(
        "id", "g", "v", F.row_number().over(w.orderBy(F.col("v").desc_nulls_last(), "id")).cast("long"), F.rank().over(w).cast("long"),
        F.dense_rank().over(w).cast("long"), F.count("*").over(Window.partitionBy("g")),
    )
    assert multiset(got) == multiset(want)


def test_a_tie_of_half_the_rows_is_spread(spark):
    from strata.operators import windows

    df = spark.range(200_000).select("id", F.lit(1).alias("g"), F.when(F.col("id") % 2 == 0, F.lit(5.0)).otherwise(F.col("id").cast("double")).alias("v"))
    cut = windows.sliced(df, [F.col("g"), F.col("v"), F.col("id")], 16)
    sizes = [r["count"] for r in cut.groupBy("_pid").count().collect()]
    assert max(sizes) < 2 * 200_000 / 16
    out = windows.partitioned_numbering(df, ["g"], [("v", True)], "id", 16).filter("v = 5")
    assert tuple(out.agg(F.min("_rank"), F.max("_rank"), F.count("*")).first()) == (3, 3, 100_001)


# ------------------------------------------------------------ SNAP2 / VER3: differences by range
def test_differing_ranges(spark):
    from strata.operators.difference import differential_by_range, differing_ranges, inside
    from strata.operators.loading import differential

    schema = "k long, v string"
    old = spark.range(100_000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, None).otherwise(F.lit("x")).alias("v"))
    assert differing_ranges(old, old, "k", ["v"]) == []
    assert differing_ranges(spark.createDataFrame([], schema), spark.createDataFrame([], schema), "k", ["v"]) == []
    change = F.when(F.col("k").between(5000, 5099), F.lit("y")).otherwise(F.col("v"))
    new = old.withColumn("v", change).filter("k != 5050").unionByName(spark.createDataFrame([(5100, "twice")], schema))
    ranges = differing_ranges(old, new, "k", ["v"])
    rows = old.filter(inside("k", ranges)).count()
    assert len(ranges) == 1 and ranges[0][0] <= 5000 and ranges[0][1] >= 5100 and rows < 200
    got, want = differential_by_range(old, new.filter("v != 'twice' OR v IS NULL"), "k"), differential(old, new.filter("v != 'twice' OR v IS NULL"), "k")
    assert multiset(got) == multiset(want)
    # changes all over the table: few ranges that hold them all
    scattered = old.withColumn("v", F.when(F.col("k") % 10 == 0, F.lit("z")).otherwise(F.col("v")))
    spread = differing_ranges(old, scattered, "k", ["v"])
    assert len(spread) <= 64 and scattered.filter("v = 'z'").filter(~inside("k", spread)).count() == 0


def test_difference_bounds_reach_the_scan(spark, tmp_dir):
    from strata.operators.difference import differential_by_range

    old = spark.range(10_000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    old.write.parquet(f"{tmp_dir}/old")
    old.withColumn("v", F.when(F.col("k") == 77, F.lit("y")).otherwise(F.col("v"))).write.parquet(f"{tmp_dir}/new")
    diff = differential_by_range(spark.read.parquet(f"{tmp_dir}/old"), spark.read.parquet(f"{tmp_dir}/new"), "k")
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(k,") == 2 and [tuple(r) for r in diff.collect()] == [("U", 77, "y")]


# ------------------------------------------------------------ SNK7: a hot day
def test_a_hot_day_is_written_by_many_tasks(spark, tmp_dir):
    from strata.sources.files import write_time_partitioned

    df = spark.range(5000).select("id", F.when(F.col("id") % 10 != 0, F.lit("2024-01-01 05:00:00")).otherwise(F.concat(F.lit("2024-02-1"), F.col("id") % 7, F.lit(" 01:00:00"))).cast("timestamp_ntz").alias("ts"))
    write_time_partitioned(df, f"{tmp_dir}/store", "ts", rows_per_file=500)
    back = spark.read.parquet(f"{tmp_dir}/store")
    assert back.count() == 5000
    per_day = {str(r["event_date"]): r["n"] for r in back.withColumn("f", F.input_file_name()).groupBy("event_date").agg(F.countDistinct("f").alias("n")).collect()}
    assert per_day.pop("2024-01-01") >= 5 and set(per_day.values()) == {1}


def test_discovery(spark, tmp_dir):
    from strata.sources.tables import discover

    spark.range(3).write.parquet(f"{tmp_dir}/a.parquet")
    spark.range(3).selectExpr("cast(id as int) id").write.parquet(f"{tmp_dir}/b.parquet")
    got = discover(spark, tmp_dir, {"a": "id bigint", "b": "id bigint", "c": "id bigint"})
    assert got == {"a": ("known", ""), "b": ("changed", "-id bigint, +id int"), "c": ("missing", "")}
    assert discover(spark, tmp_dir, {})["a"] == ("unknown", "id bigint")


# ------------------------------------------------------------ AGG8: lists in pieces
@pytest.mark.parametrize("chars", [1, 7, 50, 1 << 20])
def test_list_pieces_make_the_whole_list(spark, chars):
    from strata.operators.lists import list_pieces, rendered

    rng = random.Random(chars)
    rows = [(rng.choice("ab"), rng.choice(["x", "longer name", None, "", "é"])) for _ in range(300)] + [("none", None)]
    out = rendered(list_pieces(spark.createDataFrame(rows, "k string, v string"), "k", "v", piece_chars=chars)).collect()
    for key in "ab":
        pieces = sorted((r["piece"], r["text"]) for r in out if r["k"] == key)
        assert ", ".join(t for _, t in pieces) == ", ".join(sorted(v for k, v in rows if k == key and v is not None))
        assert all(len(t) <= chars + len("longer name") for _, t in pieces)
    assert {r["k"] for r in out} == {"a", "b"}


def test_a_hot_list_stays_in_bounded_rows(spark):
    from strata.operators.lists import list_pieces, rendered

    hot = spark.range(10_000_000).select(F.lit("k").alias("k"), F.concat(F.lit("name "), F.col("id") % 3).alias("v"))
    pieces = list_pieces(hot, "k", "v", piece_chars=1 << 16)
    sizes = rendered(pieces).select(F.length("text").alias("n")).agg(F.max("n"), F.sum("n"), F.count("*")).first()
    assert sizes[0] <= (1 << 16) + 6 and sizes[1] + 2 * sizes[2] == 8 * 10_000_000
