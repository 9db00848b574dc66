"""Recursive hierarchies (SUB7).

``resolve`` finds every node's path from its root by pointer doubling: a row stands for a
piece of a path, and each round joins it with the piece that ends where it begins, so that
pieces double and a hierarchy of depth d takes log2(d) rounds.  ``walk`` is the plain
iteration for steps that are no lookup of a parent: one join per level.

Rounds are written to the shared checkpoint folder, so lineage stays short and a lost
executor recomputes one round, not the whole recursion.  A cycle raises; it never gives a
partial result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .staging import staged

#: Nodes of a cycle that the error names.
NAMED = 20


def resolve(anchors: DataFrame, edges: DataFrame, separator: str = " > ", limit: int = 255) -> DataFrame:
    """(node, path, level) of all anchors and what is below them.

    ``anchors`` has (node, label); ``edges`` has (node, label, parent), and an anchor has
    no edge of its own.  ``path`` joins the labels from the anchor down, cut to ``limit``
    characters; an anchor's level is 0.  A node with several parents has one row per path.
    Nodes that no anchor is above are left out; edges without a parent or to the node
    itself are skipped; a NULL label makes the paths through it NULL.

    A piece of a path keeps the least node among the ancestors it covers.  In a cycle the
    least node meets itself there as soon as its piece is as long as the cycle, and that
    raises ``RecursionError`` with the cycle's nodes.
    """
    steps = edges.filter("parent IS NOT NULL AND parent != node").select("node", "label", "parent")
    tops = anchors.select(F.col("node").alias("top"), F.left("label", F.lit(limit)).alias("top_path"), F.lit(True).alias("there"))
    parent = F.col("parent").alias("top")
    pieces = steps.select("node", parent, F.left("label", F.lit(limit)).alias("path"), F.lit(1).alias("level"), F.col("parent").alias("low"))
    joined = F.left(F.concat("top_path", F.lit(separator), "path"), F.lit(limit))
    rooted = pieces.join(tops, "top", "left").withColumn("done", F.coalesce("there", F.lit(False)))
    rooted = rooted.withColumn("path", F.when(F.col("done"), joined).otherwise(F.col("path")))
    pieces = staged(rooted.drop("top_path", "there"), "pieces")
    while True:
        state = pieces.agg(F.count(F.when(~F.col("done"), 1)).alias("open"), F.min(F.when(F.col("low") == F.col("node"), F.col("node"))).alias("own"))
        n_open, own = state.first()
        if own is not None:
            raise RecursionError(f"the hierarchy has a cycle: {' -> '.join(map(str, _cycle(steps, own)))}")
        if not n_open:
            break
        above = pieces.select(F.col("node").alias("top"), F.col("top").alias("next"), F.col("path").alias("top_path"),
                              F.col("level").alias("more"), F.col("low").alias("lower"), F.col("done").alias("there"))
        longer = pieces.filter("NOT done").join(above, "top").select(
            "node", F.col("next").alias("top"), joined.alias("path"), (F.col("level") + F.col("more")).alias("level"),
            F.least("low", "lower").alias("low"), F.col("there").alias("done"),
        )
        pieces = staged(pieces.filter("done").unionByName(longer), "pieces")
    first = anchors.select("node", F.left("label", F.lit(limit)).alias("path"), F.lit(0).alias("level"))
    return first.unionByName(pieces.select("node", "path", "level"))


def _cycle(steps: DataFrame, node) -> list:
    """The nodes of the cycle through ``node`` and back to it, the first ones of a long one."""
    out = [node]
    while len(out) <= NAMED and (len(out) == 1 or out[-1] != node):
        out.append(steps.filter(F.col("node") == F.lit(out[-1])).agg(F.min("parent")).first()[0])
    return out


def walk(
    anchor: DataFrame,
    step: Callable[[DataFrame], DataFrame],
    max_depth: int = 1000,
) -> DataFrame:
    """Union of ``anchor`` and repeated ``step(previous_level)`` until a level is empty.

    ``step`` receives the rows of the previous level and returns the next level
    with the same columns.  More than ``max_depth`` levels below the anchor raise
    ``RecursionError``.
    """
    ensure_checkpoint_dir(anchor.sparkSession)
    frontier = anchor.checkpoint()
    levels = [frontier]
    while True:
        nxt = step(frontier).checkpoint()
        if nxt.isEmpty():
            break
        if len(levels) > max_depth:
            raise RecursionError(f"the hierarchy has more than {max_depth} levels below its anchor, or a cycle")
        levels.append(nxt)
        frontier = nxt
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out
