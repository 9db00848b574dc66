"""Mixing sources to target weights, in DataFrame operations only.

Words are counted per document and summed per source; the target of a source follows
from its weight and a cap; every document is then emitted ``floor(rate)`` times plus one
more time when a hash of the seed and its id falls below the fraction of the rate.  Each
source takes, of ``SEEDS`` seeds, the one whose draws bring its words nearest to its target:
one aggregate sums the words that every seed would take.  The hash is ``x + seed * y`` of
two numbers made of the id, so draws of different seeds are independent in pairs.

Sources are ranked, and their caps summed, over range-partitioned slices and offsets, so
their number is not bounded by a task.  Defined results: a null text has size 0; a null
source is a source of its own, ranked last; a source without words has rate 0; rows that
repeat a doc_id share one draw; an empty table gives an empty result; columns that share a
name with a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import partitions, written

#: Seeds that each source chooses from, and hexadecimal digits of the md5 that make each of its two numbers.
SEEDS, DIGITS = 64, 7
DRAWS = 16**DIGITS


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def running_sums(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with the sum of each column over the rows before it in a total order, and ``<name>_all`` over all rows."""
    ranged = df.repartitionByRange(partitions(df.sparkSession), *order)
    slices = written(ranged.withColumn("_slice", F.spark_partition_id()), "slices")
    inside = W.partitionBy("_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    per_slice = slices.groupBy("_slice").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    earlier, every = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1), W.orderBy("_slice").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    offsets = per_slice.select(  # a row per slice
        "_slice",
        *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}_before") for n in sums],
        *[F.sum(f"_{n}").over(every).alias(f"{n}_all") for n in sums],
    )
    run = slices.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_{n}_here") for n, c in sums.items()])
    joined = run.join(F.broadcast(offsets), "_slice")
    return joined.select(*df.columns, *[(F.col(f"_{n}_before") + F.col(f"_{n}_here")).alias(n) for n in sums], *[f"{n}_all" for n in sums])


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_rate: float = 3.0) -> DataFrame:
    """One row per source: source, source_size, weight, target.

    ``sizes`` has source and size.  All targets add up to all sizes.  They are in
    proportion to the weights, except that none is above ``max_rate`` times its source's
    size: sources are ordered by where they reach that cap, and the level is the first at
    which all that follow stay below theirs.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running_sums(per_source, [F.col("source").asc_nulls_last()], {"rank": F.lit(1)}).drop("rank_all")
    weighted = ranked.withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))).withColumn(
        "cap", F.lit(max_rate) * F.col("source_size")
    )
    by_cap = [(F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    summed = written(
        running_sums(weighted, by_cap, {"capped": F.col("cap"), "words": F.col("source_size"), "weighed": F.col("weight"), "place": F.lit(1)}),
        "sources",
    )
    level = (F.col("words_all") - F.col("capped")) / (F.col("weighed_all") - F.col("weighed"))
    holds = F.when(level * F.col("weight") <= F.col("cap"), F.col("place"))
    first = summed.agg(F.min_by(level, holds).alias("level"))
    return summed.crossJoin(F.broadcast(first)).select(  # one row
        "source", "source_size", "weight", F.least("cap", F.col("level") * F.col("weight")).alias("target")
    )


def numbers(key: Column, name: str) -> tuple[Column, Column]:
    """Two numbers below DRAWS that depend on the name and the key alone."""
    digest = F.md5(F.concat(F.lit(f"{name}:"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))
    x, y = (F.conv(F.substring(digest, at, DIGITS), 16, 10).cast("long") for at in (1, 1 + DIGITS))
    return x, y


def draw(seed: Column, x: Column, y: Column) -> Column:
    """A whole number below DRAWS, of a seed and a key's numbers."""
    return F.pmod(x + seed * y, F.lit(DRAWS))


def rate(target: Column, source_size: Column) -> Column:
    return F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))


def with_seeds(sizes: DataFrame, targets: DataFrame, name: str = "mix") -> DataFrame:
    """``targets`` with each source's seed: the first of those whose draws take nearest to the target.

    ``sizes`` has doc_id, source and size.
    """
    t = targets.select(F.col("source").alias("t_source"), rate(F.col("target"), F.col("source_size")).alias("rate"))
    fraction = F.col("rate") - F.floor("rate")
    x, y = numbers(F.col("doc_id"), name)
    held = sizes.filter("size > 0").join(t, F.col("source").eqNullSafe(F.col("t_source")))
    # the two numbers and the bound, once for all seeds
    held = held.select("t_source", "size", x.alias("x"), y.alias("y"), (fraction * DRAWS).alias("below"))
    taken = [F.sum(F.when(draw(F.lit(s), F.col("x"), F.col("y")) < F.col("below"), F.col("size")).otherwise(0)).alias(f"s{s}") for s in range(SEEDS)]
    per_source = held.groupBy("t_source").agg(*taken)
    wanted = F.col("target") - F.floor(rate(F.col("target"), F.col("source_size"))) * F.col("source_size")
    misses = F.array(*[F.struct(F.abs(F.coalesce(f"s{s}", F.lit(0)) - wanted).alias("miss"), F.lit(s).alias("seed")) for s in range(SEEDS)])
    joined = targets.join(per_source, F.col("source").eqNullSafe(F.col("t_source")), "left")
    return joined.select("source", "source_size", "target", F.array_min(misses)["seed"].alias("seed"))


def mix_sources(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_rate: float = 3.0, seed: str = "mix", size: Column | None = None
) -> DataFrame:
    """``docs`` with size (by default the words of text), source_size, target (of the source),
    rate and copies, one row per document."""
    sized = docs.withColumn("size", word_count(F.col("text")) if size is None else size)
    narrow = written(sized.select("doc_id", "source", "size"), "sizes")
    targets = written(source_targets(narrow, weights, max_rate), "targets")
    chosen = written(with_seeds(narrow, targets, seed), "seeds").select(
        F.col("source").alias("target_source"), "source_size", "target", F.col("seed").alias("source_seed")
    )
    taken = ("source_size", "target", "rate", "copies", "target_source", "source_seed")
    joined = sized.select(*[c for c in sized.columns if c not in taken]).join(chosen, F.col("source").eqNullSafe(F.col("target_source")))
    joined = joined.withColumn("rate", rate(F.col("target"), F.col("source_size")))
    drawn = draw(F.col("source_seed"), *numbers(F.col("doc_id"), seed))
    extra = (drawn < (F.col("rate") - F.floor("rate")) * DRAWS).cast("long")
    return joined.withColumn("copies", F.floor("rate") + extra).drop("target_source", "source_seed")


def emit_copies(mixed: DataFrame) -> DataFrame:
    """Every row as often as its copies say, numbered from 1 in copy."""
    rows = mixed.drop("copy").filter(F.col("copies") > 0)
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
