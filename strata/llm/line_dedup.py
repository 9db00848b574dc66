"""Line deduplication over range-partitioned, sorted line hashes.

Every distinct line of a document becomes one row (hash, doc_id, tag, positions), without
its text.  The rows are range-partitioned by hash and document and sorted within the
partitions, so each partition streams its runs of equal hashes and holds no more than
``min_docs`` rows.  A run at a partition's edge may go on in the next one: its rows are
set aside, and one count per edge (two per partition at most) settles them.  The result
is, per document, the compressed bitmap of the lines it keeps.

A line's key is the line without white space (U+0020, U+0009 to U+000D) at both ends and
with A-Z lower-cased; an empty key is never dropped.  Defined results: a null or empty
text is one empty line; rows equal in doc_id and text count as one document and share its
bitmap; a null doc_id is a document of its own; an empty table gives an empty result;
other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, mapped, partitions, text_tag, texts, written

STRIPPED = ASCII_SPACE.encode()
ROW = "h1 long, h2 long, doc_id long, tag long, positions array<int>"
#: Column of a document's bitmap; columns of the input can't have this name.
BITMAP = "_keep_bitmap"
#: What a streamed row is: a line to drop, one whose run another partition decides, or a run's count at an edge.
DROP, PENDING, COUNT = 0, 1, 2


def line_keys(text: bytes) -> list[bytes]:
    return [line.strip(STRIPPED).lower() for line in text.split(b"\n")]


def _line_rows(batch):
    doc_ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
    tags = batch.column(batch.schema.get_field_index("tag")).to_pylist()
    hashes, owners, where = [], [], []
    for i, text in enumerate(texts(batch)):
        lines: dict[bytes, list[int]] = {}
        for at, key in enumerate(line_keys(text)):
            if key:
                lines.setdefault(key, []).append(at)
        hashes += [xxhash.xxh3_128_digest(key) for key in lines]
        owners += [i] * len(lines)
        where += lines.values()
    both = np.frombuffer(b"".join(hashes), dtype=np.int64).reshape(-1, 2)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(both[:, 0]),
            pa.array(both[:, 1]),
            pa.array([doc_ids[i] for i in owners], pa.int64()),
            pa.array([tags[i] for i in owners], pa.int64()),
            pa.array(where, pa.list_(pa.int32())),
        ],
        names=["h1", "h2", "doc_id", "tag", "positions"],
    )


class _Out:
    """Collects output rows and hands them over in batches."""

    def __init__(self):
        self.rows: list[tuple] = []

    def add(self, row: tuple, kind: int, n_docs: int = 0) -> None:
        self.rows.append((*row, kind, n_docs))

    def batches(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            columns = list(zip(*self.rows, strict=True))
            types = [pa.int64()] * 4 + [pa.list_(pa.int32()), pa.int32(), pa.int64()]
            names = ["h1", "h2", "doc_id", "tag", "positions", "kind", "n_docs"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
            self.rows = []


def _stream(min_docs: int, keep_first: bool):
    """Runs of equal hashes of one sorted partition."""

    def run(batches):
        out, key, doc, count, held, first_run = _Out(), None, None, 0, [], True

        def first(row):  # the first occurrence stays where that is asked for
            return (*row[:4], row[4][1:])

        def close(last: bool):
            """What an ended run leaves: an edge's rows wait for the other partitions."""
            if key is None:
                return
            if first_run or last:
                for row in held:
                    out.add(row, PENDING)
                out.add((*key, *earliest, None), COUNT, count)

        earliest = (None, None)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:2] != key:
                    if key is not None:
                        close(False)
                        first_run = False
                    if key is None:
                        first_run = True
                    key, doc, count, held, earliest = row[:2], None, 0, [], row[2:4]
                if row[2:4] == doc:
                    continue  # the same document again
                doc, count = row[2:4], count + 1
                if first_run:
                    out.add(row, PENDING)
                elif count < min_docs:
                    held.append(row)
                else:
                    for i, r in enumerate([*held, row]):
                        out.add(first(r) if keep_first and i == 0 and count == len(held) + 1 else r, DROP)
                    held = []
            yield from out.batches(5000)
        if key is not None:
            close(True)
        yield from out.batches()

    return run


def dropped_lines(docs: DataFrame, min_docs: int = 2, keep_first: bool = True) -> DataFrame:
    """(doc_id, tag, positions) of lines to drop: those in ``min_docs`` documents or more,
    except, with ``keep_first``, their first occurrence by document and position."""
    spark = docs.sparkSession
    lines = mapped(docs.select("doc_id", text_tag().alias("tag"), "text"), _line_rows, ROW)
    ordered = lines.repartitionByRange(partitions(spark), "h1", "h2", "doc_id", "tag").sortWithinPartitions(
        "h1", "h2", "doc_id", "tag"
    )
    streamed = written(
        ordered.mapInArrow(_stream(min_docs, keep_first), ROW + ", kind int, n_docs long"), "line-runs"
    )
    edges = (  # two rows per partition at most
        streamed.filter(F.col("kind") == COUNT)
        .groupBy("h1", "h2")
        .agg(F.sum("n_docs").alias("docs"), F.min(F.struct("doc_id", "tag")).alias("earliest"))
        .filter(F.col("docs") >= min_docs)
    )
    positions = F.col("positions")
    if keep_first:
        is_first = F.struct("doc_id", "tag").eqNullSafe(F.col("earliest"))
        positions = F.when(is_first, F.slice("positions", 2, 2**31 - 1)).otherwise(positions)
    pending = streamed.filter(F.col("kind") == PENDING).join(F.broadcast(edges), ["h1", "h2"])
    settled = pending.select("doc_id", "tag", positions.alias("positions"))
    return streamed.filter(F.col("kind") == DROP).select("doc_id", "tag", "positions").unionAll(settled)


def _bitmap(drops: list[int]) -> bytes:
    """Bits of the kept lines up to the last dropped one, in whole bytes, compressed; later lines are kept."""
    bits = np.ones((max(drops, default=-1) // 8 + 1) * 8, dtype=np.uint8)
    bits[drops] = 0
    return zlib.compress(np.packbits(bits).tobytes(), 6)


def _bitmaps(batch):
    drops = batch.column(batch.schema.get_field_index("drops")).to_pylist()
    keep = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "tag")]
    bitmaps = pa.array([_bitmap(d) for d in drops], pa.binary())
    yield pa.RecordBatch.from_arrays([*keep, bitmaps], names=["doc_id", "tag", "bitmap"])


def keep_bitmaps(docs: DataFrame, min_docs: int = 2, keep_first: bool = True) -> DataFrame:
    """(doc_id, tag, bitmap) of the documents that lose lines; ``kept_lines`` reads a bitmap."""
    dropped = dropped_lines(docs, min_docs, keep_first).groupBy("doc_id", "tag")
    return mapped(dropped.agg(F.flatten(F.collect_list("positions")).alias("drops")), _bitmaps, "doc_id long, tag long, bitmap binary")


def kept_lines(text: bytes, bitmap: bytes | None) -> tuple[int, int, bytes]:
    """Number of lines, number dropped, and the text of those that stay."""
    lines = text.split(b"\n")
    if bitmap is None:
        return len(lines), 0, text
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8))[: len(lines)].tolist()
    stay = [line for i, line in enumerate(lines) if i >= len(bits) or bits[i]]
    return len(lines), len(lines) - len(stay), b"\n".join(stay)


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its bitmap, null where it keeps all lines."""
    b = bitmaps.toDF("_keep_doc", "_keep_tag", BITMAP)
    on = F.col("doc_id").eqNullSafe(F.col("_keep_doc")) & (text_tag() == F.col("_keep_tag"))
    return docs.join(b, on, "left").drop("_keep_doc", "_keep_tag")


def _digests(batch):
    found = [
        (*counts[:2], hashlib.sha256(counts[2]).hexdigest())
        for counts in map(kept_lines, texts(batch), batch.column(batch.schema.get_field_index(BITMAP)).to_pylist())
    ]
    n_lines, n_dropped, sha = zip(*found, strict=True) if found else ((), (), ())
    yield pa.RecordBatch.from_arrays(
        [
            batch.column(batch.schema.get_field_index("doc_id")),
            pa.array(n_lines, pa.int64()),
            pa.array(n_dropped, pa.int64()),
            pa.array(sha, pa.string()),
        ],
        names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    )


def line_digests(docs: DataFrame, min_docs: int, keep_first: bool) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row."""
    rows = with_bitmaps(docs.select("doc_id", "text"), keep_bitmaps(docs, min_docs, keep_first))
    return mapped(rows, _digests, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def _kept_texts(batch):
    bitmaps = batch.column(batch.schema.get_field_index(BITMAP)).to_pylist()
    kept = [None if b is None else kept_lines(t, b)[2].decode() for t, b in zip(texts(batch), bitmaps, strict=True)]
    columns = dict(zip(batch.schema.names, batch.columns, strict=True))
    old = columns.pop("text")
    del columns[BITMAP]
    text = [o.as_py() if k is None else k for o, k in zip(old, kept, strict=True)]
    columns["_kept_text"] = pa.array(text, pa.string())
    yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def drop_lines(docs: DataFrame, min_docs: int = 2, keep_first: bool = True) -> DataFrame:
    """``docs`` without its repeated lines; rows whose every line went stay, with an empty text."""
    rows = with_bitmaps(docs, keep_bitmaps(docs, min_docs, keep_first))
    rest = [c for c in docs.columns if c != "text"]
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in rest), "_kept_text string"])
    out = mapped(rows.select(*rest, "text", BITMAP), _kept_texts, fields)
    return out.select(*[F.col("_kept_text").alias("text") if c == "text" else c for c in docs.columns])
