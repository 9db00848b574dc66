"""Merkle manifest of a table, with a witness for every row.

The leaves of a tree are numbered in order without a window over a tree: the narrow leaf
rows are range-partitioned, sorted and written once, and the counts per slice and tree give
the offsets.  Leaves are then dealt to aligned blocks of ``FAN ** levels``.  A task streams
a block's leaves into a frontier of open subtrees: a leaf joins the lowest open subtree with
an empty witness; a subtree that gets its last child closes, which extends the witnesses of
all leaves below it by the siblings, and it is appended one level up.  The blocks' roots are
the leaves of the next round, appended in the same way, until every tree has one node; the
trees' roots are appended to one more tree.  A leaf's whole witness is its own in its block,
then that of its block, and so on, joined on (tree, block), so a hot tree is split by blocks.

``H`` is the lowercase hex SHA-256 of its inputs, concatenated; digests go in as hex text.
Every ``FAN`` consecutive nodes become their H, the last run of a level may have fewer, even
one, and a tree of one leaf is that leaf.  A witness lists, level by level, the place in the
run and the siblings left to right: a byte (place * 16 + number of siblings), then 32 bytes
each.

Defined results: a null in a hashed column is written ``-`` and so differs from an empty
text; a null source is a tree of its own, the first; rows of one source that share a doc_id
are ordered by their leaf, and equal rows are leaves each; a null doc_id comes first; an
empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import partitions, written

FAN = 3
HASHED = ("doc_id", "source", "lang", "n_chars", "text")
#: Bits of a row's number inside its partition, as monotonically_increasing_id has it.
ROW_BITS = 33
NODE = "tree string, kind int, at long, total long, digest string, witness binary"
MEMBER, ROOT = 0, 1


def h(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def depth(total: int, most: int = 64) -> int:
    """Levels above the leaves of a tree of ``total`` leaves, ``most`` at the most."""
    levels, reach = 0, 1
    while reach < total and levels < most:
        levels, reach = levels + 1, reach * FAN
    return levels


class Frontier:
    """Open subtrees of a tree that leaves are appended to, and the witnesses of its leaves so far."""

    def __init__(self):
        self.open: list[list[tuple[bytes, list[bytearray]]]] = [[]]
        self.witnesses: list[bytearray] = []

    def append(self, digest: bytes) -> None:
        self.witnesses.append(bytearray())
        self._add(0, (digest, [self.witnesses[-1]]))

    def _add(self, level: int, node: tuple[bytes, list[bytearray]]) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(node)
        if len(self.open[level]) == FAN:
            self._close(level)

    def _close(self, level: int) -> None:
        """The run becomes its parent; each leaf below it learns the siblings of its own child."""
        run, self.open[level] = self.open[level], []
        raw = [bytes.fromhex(digest.decode()) for digest, _ in run]
        below: list[bytearray] = []
        for place, (_, leaves) in enumerate(run):
            step = bytes([place * 16 + len(run) - 1]) + b"".join(raw[:place] + raw[place + 1 :])
            for witness in leaves:
                witness += step
            below += leaves
        self._add(level + 1, (h(*(digest for digest, _ in run)), below))

    def finish(self, levels: int) -> bytes:
        """Close what is open below ``levels``; the one node there is left."""
        for level in range(levels):
            if level < len(self.open) and self.open[level]:
                self._close(level)
        return self.open[levels][0][0]


def _append_blocks(levels: int):
    """Rows (tree, at, total, digest) in order become members with their witness in their block, and the blocks' roots."""
    size = FAN**levels
    types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["tree", "kind", "at", "total", "digest", "witness"])

    def finished(tree: str, number: int, total: int, held: list[int], frontier: Frontier) -> list[tuple]:
        blocks = -(-total // size)
        root = frontier.finish(depth(total, levels) if blocks == 1 else levels)
        rows = [(tree, MEMBER, at, total, None, bytes(w)) for at, w in zip(held, frontier.witnesses, strict=True)]
        return [*rows, (tree, ROOT, number, blocks, root.decode(), None)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, frontier, block, total = [], [], Frontier(), None, 0
        for batch in batches:
            for tree, at, n, digest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (tree, at // size) != block:
                    if block is not None:
                        rows += finished(*block, total, held, frontier)
                    held, frontier, block, total = [], Frontier(), (tree, at // size), n
                held.append(at)
                frontier.append(digest.encode())
            if len(rows) > 5000:
                yield batch_of(rows)
                rows = []
        if block is not None:
            yield batch_of(rows + finished(*block, total, held, frontier))

    return run


def numbered(df: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``df`` with at (its place in its tree, from 0) and total (the tree's rows).

    ``order`` must be unique in a tree.  ``tree`` holds no null.
    """
    keys = [F.col(c).asc_nulls_first() for c in [tree, *order]]
    ranged = df.repartitionByRange(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)
    slices = written(ranged.withColumn("_row", F.monotonically_increasing_id()).withColumn("_slice", F.spark_partition_id()), "leaf-order")
    runs = slices.groupBy(tree, "_slice").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = W.partitionBy(tree).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)  # a row per slice
    offsets = runs.select(
        F.col(tree).alias("_tree"),
        F.col("_slice").alias("_of"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(W.partitionBy(tree)).alias("total"),
    )
    joined = slices.drop("at", "total").join(offsets, (F.col(tree) == F.col("_tree")) & (F.col("_slice") == F.col("_of")))
    return joined.withColumn("at", F.col("_row") + F.col("_shift")).drop("_row", "_slice", "_tree", "_of", "_shift")


def appended(leaves: DataFrame, levels: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fold trees of (tree, at, total, digest) to their roots.

    Returns (tree, at, witness) of the leaves in their block, (tree, block, rest) with the
    witness of each such block up to its tree's root, and (tree, digest) of the roots.
    """
    size, members, tops, items = FAN**levels, [], [], leaves
    while True:
        dealt = items.select("tree", "at", "total", "digest", F.floor(F.col("at") / size).alias("block"))
        ordered = dealt.repartition(partitions(leaves.sparkSession), "tree", "block").sortWithinPartitions("tree", "at")
        folded = written(ordered.select("tree", "at", "total", "digest").mapInArrow(_append_blocks(levels), NODE), "blocks")
        members.append(folded.filter(F.col("kind") == MEMBER).select("tree", "at", "witness"))
        roots = folded.filter(F.col("kind") == ROOT).select("tree", "at", "total", "digest")
        tops.append(roots)
        items = roots.filter("total > 1")
        if items.isEmpty():
            break
    rest = None
    for k in reversed(range(len(tops))):  # a block's witness in the next round, then that round's block's, and so on
        blocks = tops[k].select("tree", F.col("at").alias("block"))
        if rest is None:
            rest = blocks.withColumn("rest", F.lit(b""))
            continue
        above = members[k + 1].withColumnRenamed("at", "block").withColumn("up", F.floor(F.col("block") / size))
        above = above.join(rest.select("tree", F.col("block").alias("up"), "rest"), ["tree", "up"])
        above = above.select("tree", "block", F.concat("witness", "rest").alias("rest"))
        rest = blocks.join(above, ["tree", "block"], "left").withColumn("rest", F.coalesce("rest", F.lit(b"")))
    finished = [t.filter("total = 1").select("tree", "digest") for t in tops]
    done = finished[0]
    for more in finished[1:]:
        done = done.unionAll(more)
    return members[0], rest, done


def leaf(columns: tuple[str, ...] = HASHED, replaced: dict[str, Column] | None = None) -> Column:
    """H of the columns in order: ``-`` for null, else the UTF-8 byte count, ``:`` and the value."""

    def field(name: str) -> Column:
        value = (replaced or {}).get(name, F.col(name)).cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*(field(c) for c in columns)).cast("binary"), 256)


def manifest(docs: DataFrame, carried: dict[str, Column] | None = None, levels: int = 6) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, leaf, subroot, root, witness and the ``carried``
    columns.  A task folds ``levels`` levels of a tree in one block; the result is the same for any."""
    size, extra = FAN**levels, list(carried or {})
    rows = docs.select(
        F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), "source")).alias("tree"),
        "doc_id",
        "source",
        leaf().alias("digest"),
        *(c.alias(name) for name, c in (carried or {}).items()),
    )
    rows = written(rows.withColumn("_tie", F.monotonically_increasing_id()), "leaves")
    placed = written(numbered(rows, "tree", ["doc_id", "digest", "_tie"]).drop("_tie"), "placed")
    own, rest, subroots = appended(placed, levels)

    subroots = written(subroots, "subroots")
    listed = written(numbered(subroots.select(F.lit("").alias("top"), "tree", "digest"), "top", ["tree"]), "listed")
    own_top, rest_top, root = appended(listed.select(F.col("top").alias("tree"), "at", "total", "digest"), levels)
    above = own_top.withColumn("block", F.floor(F.col("at") / size)).join(rest_top.select("block", "rest"), "block")
    above = above.select("at", F.concat("witness", "rest").alias("to_root")).join(listed.select("at", "tree", F.col("digest").alias("subroot")), "at")
    above = above.crossJoin(F.broadcast(root.select(F.col("digest").alias("root"))))  # one row
    rest = written(rest.join(above.drop("at"), "tree").withColumn("rest", F.concat("rest", "to_root")).drop("to_root"), "rest")

    # all leaves meet their block's witness on (tree, block): a hot source has as many keys as blocks
    whole = own.withColumn("block", F.floor(F.col("at") / size)).join(rest, ["tree", "block"])
    joined = placed.drop("total").join(whole.drop("block"), ["tree", "at"])
    return joined.select(
        "doc_id", "source", F.col("digest").alias("leaf"), "subroot", "root", F.concat("witness", "rest").alias("witness"), *extra
    )


def steps(witness: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """(place in the run, siblings as hex) of each level."""
    at = 0
    while at < len(witness):
        place, n = divmod(witness[at], 16)
        yield place, [witness[i : i + 32].hex().encode() for i in range(at + 1, at + 1 + 32 * n, 32)]
        at += 1 + 32 * n


def fold(digest: bytes, witness: bytes) -> bytes:
    """The root that a leaf's digest leads to along its witness."""
    for place, siblings in steps(witness):
        digest = h(*siblings[:place], digest, *siblings[place:])
    return digest


def proof_digest(witness: bytes) -> str:
    return h(*(s for _, siblings in steps(witness) for s in siblings)).decode()


def verified(proofs: DataFrame, presented: str) -> DataFrame:
    """``proofs`` (doc_id, leaf, subroot, root, witness and the column ``presented``) with
    proof_sha256, folded_root (of the presented digest) and verified in place of both."""

    def run(batches):
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            witnesses, given = columns.pop("witness").to_pylist(), columns.pop(presented).to_pylist()
            roots = columns["root"].to_pylist()
            folded = [fold(g.encode(), w).decode() for g, w in zip(given, witnesses, strict=True)]
            columns["proof_sha256"] = pa.array([proof_digest(w) for w in witnesses], pa.string())
            columns["folded_root"] = pa.array(folded, pa.string())
            columns["verified"] = pa.array([f == r for f, r in zip(folded, roots, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return proofs.select("doc_id", "leaf", "subroot", "root", "witness", presented).mapInArrow(run, schema)


def tampered_leaf() -> Column:
    """The leaf of the row with its text's line ends deleted, where 2 divides crc32(doc_id as text)."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return leaf(replaced={"text": text})


def audit(docs: DataFrame, levels: int = 6) -> DataFrame:
    """Proofs of all rows, checked against a copy of the table with tampered texts.

    A null doc_id is not tampered with.
    """
    return verified(manifest(docs, {"presented": tampered_leaf()}, levels), "presented")
