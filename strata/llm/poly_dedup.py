"""Exact deduplication by composable polynomial fingerprints.

A text's fingerprint is its length and the value, at four points, of the polynomial whose
coefficients are its bytes, each modulo a 31-bit prime.  Chunks are evaluated on their own
and combine by ``h(xy) = h(x) * base**len(y) + h(y)``, so a huge text needs neither one
pass nor one buffer.  Texts with equal fingerprints are then compared chunk by chunk with
the one that stays, in a join on (fingerprint, chunk number); a text that differs (a
collision) is grouped by its SHA-256 as well.

Texts are equal when identical after lower-casing A-Z.  Defined results: a null text
counts as empty; of equal texts the row with the largest doc_id stays, a null doc_id
counts as the smallest, and rows equal in doc_id and text count each, the first of them
being the one that stays; an empty table gives an empty result; other columns of the
input are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, text_tag, texts, written

# Four primes below 2**31 and a base for each.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (1103515245, 1220703125, 1597334677, 1812433253)
#: Bytes per chunk: 2**8 * 2**31 * 2**16 stays below 2**64.
CHUNK = 1 << 16


def _powers(base: int, prime: int) -> np.ndarray:
    """base**(CHUNK-1) .. base**0 modulo prime, by doubling."""
    out = np.ones(1, dtype=np.uint64)
    while len(out) < CHUNK:
        out = np.concatenate([out * np.uint64(pow(base, len(out), prime)) % np.uint64(prime), out])
    return out[-CHUNK:]


_TABLES = [_powers(b, p) for b, p in zip(BASES, PRIMES, strict=True)]


def chunk_hash(data: np.ndarray) -> tuple[int, ...]:
    """The four values of one chunk of at most CHUNK bytes."""
    wide = data.astype(np.uint64)
    return tuple(int(np.dot(wide, t[CHUNK - len(wide) :])) % p for t, p in zip(_TABLES, PRIMES, strict=True))


def combine(left: tuple[int, ...], right: tuple[int, ...], right_length: int) -> tuple[int, ...]:
    """The values of the concatenation."""
    return tuple(
        (x * pow(b, right_length, p) + y) % p for x, y, b, p in zip(left, right, BASES, PRIMES, strict=True)
    )


def fingerprint(data: bytes) -> bytes:
    """Length and the four combined values, 24 bytes."""
    view = np.frombuffer(data, dtype=np.uint8)
    value = (0,) * len(PRIMES)
    for at in range(0, len(view), CHUNK):
        chunk = view[at : at + CHUNK]
        value = combine(value, chunk_hash(chunk), len(chunk))
    return len(data).to_bytes(8, "big") + b"".join(v.to_bytes(4, "big") for v in value)


def _fingerprints(batch):
    prints, shas = [], []
    for text in texts(batch):
        low = text.lower()  # of bytes: A-Z only
        prints.append(fingerprint(low))
        shas.append(hashlib.sha256(low).hexdigest())
    rows = batch.num_rows
    yield pa.RecordBatch.from_arrays(
        [
            batch.column(batch.schema.get_field_index("doc_id")),
            batch.column(batch.schema.get_field_index("tag")),
            pa.array(prints, pa.binary()) if rows else pa.array([], pa.binary()),
            pa.array(shas, pa.string()) if rows else pa.array([], pa.string()),
        ],
        names=["doc_id", "tag", "print", "text_sha256"],
    )


def _chunks(batch):
    """One row per chunk; a text without bytes needs none, as its length is in the fingerprint."""
    keys = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "tag", "print", "stays")]
    for doc_id, tag, mark, stays, text in zip(*keys, texts(batch), strict=True):
        low = text.lower()
        for at in range(0, len(low), CHUNK << 4):
            parts = [low[i : i + CHUNK] for i in range(at, min(at + (CHUNK << 4), len(low)), CHUNK)]
            n, first = len(parts), at // CHUNK
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([doc_id] * n, pa.int64()),
                    pa.array([tag] * n, pa.int64()),
                    pa.array([mark] * n, pa.binary()),
                    pa.array([stays] * n, pa.bool_()),
                    pa.array(range(first, first + n), pa.int32()),
                    pa.array(parts, pa.binary()),
                ],
                names=["doc_id", "tag", "print", "stays", "chunk_no", "chunk"],
            )


def differing(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(doc_id, tag, print) of the members whose text is not that of the one that stays.

    ``members`` has doc_id, tag, print and stays, for fingerprints that occur more than
    once.  The member side of the chunk join is the large one: a hot fingerprint is split
    there, against one row per chunk on the other side.
    """
    keyed = docs.select("doc_id", text_tag().alias("tag"), "text")
    m = members.select(F.col("doc_id").alias("m_doc"), F.col("tag").alias("m_tag"), "print", "stays")
    held = keyed.join(m, F.col("doc_id").eqNullSafe(F.col("m_doc")) & (F.col("tag") == F.col("m_tag")))
    chunks = written(
        mapped(
            held.select("doc_id", "tag", "print", "stays", "text"),
            _chunks,
            "doc_id long, tag long, print binary, stays boolean, chunk_no int, chunk binary",
        ),
        "chunks",
    )
    staying = chunks.filter("stays").groupBy("print", "chunk_no").agg(F.max("chunk").alias("held_chunk"))
    staying = written(staying, "staying")
    return (
        chunks.filter("NOT stays")
        .join(staying, ["print", "chunk_no"], "left")
        .filter("held_chunk IS NULL OR chunk != held_chunk")
        .select("doc_id", "tag", "print")
        .distinct()
    )


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = written(
        mapped(
            docs.select("doc_id", text_tag().alias("tag"), "text"),
            _fingerprints,
            "doc_id long, tag long, print binary, text_sha256 string",
        )
        .groupBy("doc_id", "tag", "print", "text_sha256")
        .agg(F.count("*").alias("copies")),
        "prints",
    )

    def groups(rows: DataFrame, keys: list[str]) -> DataFrame:
        last = F.struct("doc_id", "tag")
        per = rows.groupBy(*keys).agg(F.sum("copies").alias("group_size"), F.count("*").alias("n"), F.max(last).alias("keep"))
        return written(per.filter("n > 1").drop("n"), "groups")

    same = groups(rows, ["print"])
    members = rows.join(same, "print").select(
        "doc_id", "tag", "print", F.struct("doc_id", "tag").eqNullSafe(F.col("keep")).alias("stays")
    )
    other = written(differing(docs, members), "collisions")
    o = other.select(F.col("doc_id").alias("o_doc"), F.col("tag").alias("o_tag"), F.lit(True).alias("differs"), F.col("print").alias("o_print"))
    split = rows.join(
        o,
        F.col("doc_id").eqNullSafe(F.col("o_doc")) & (F.col("tag") == F.col("o_tag")) & (F.col("print") == F.col("o_print")),
        "left",
    ).withColumn("side", F.when(F.col("differs"), F.col("text_sha256")).otherwise(F.lit("")))
    split = written(split.select("doc_id", "tag", "print", "text_sha256", "copies", "side"), "classes")
    classes = groups(split, ["print", "side"])
    keep = F.coalesce(F.col("keep"), F.struct("doc_id", "tag"))
    out = split.join(classes, ["print", "side"], "left").select(
        "doc_id",
        keep["doc_id"].alias("keep_id"),
        F.coalesce("group_size", "copies").alias("group_size"),
        F.struct("doc_id", "tag").eqNullSafe(keep).alias("stays"),
        "text_sha256",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    )
    return out.select("doc_id", "keep_id", "group_size", (F.col("stays") & (F.col("copy") == 1)).alias("kept"), "text_sha256")
