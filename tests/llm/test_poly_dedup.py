"""Exact deduplication against a grouping by text, also where fingerprints collide."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from strata.llm import poly_dedup
from strata.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows: list[tuple]) -> list[tuple]:
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").encode().lower()].append(doc_id)
    out = []
    for low, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known, default=None)
        first = True
        for i in ids:
            kept = i == keep and first
            first = first and not kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(low).hexdigest()))
    return sorted(out, key=str)


@given(st.binary(max_size=50), st.binary(max_size=50))
def test_values_combine(x, y):
    import numpy as np

    h = lambda b: poly_dedup.chunk_hash(np.frombuffer(b, dtype=np.uint8))
    assert poly_dedup.combine(h(x), h(y), len(y)) == h(x + y)


def test_fingerprint_of_many_chunks_is_the_polynomial():
    data = bytes(random.Random(1).randbytes(3 * poly_dedup.CHUNK + 17))
    values = [0] * 4
    for byte in data:
        values = [(v * b + byte) % p for v, b, p in zip(values, poly_dedup.BASES, poly_dedup.PRIMES, strict=True)]
    assert poly_dedup.fingerprint(data) == len(data).to_bytes(8, "big") + b"".join(v.to_bytes(4, "big") for v in values)


def table() -> list[tuple]:
    rng = random.Random(2)
    rows = [(i, rng.choice(["Aé", "aé", "AÉ", "b", "", None, "hot", "HOT", "Hot"])) for i in range(80)]
    rows += [(100, "x" * 200_000), (101, "X" * 200_000), (102, "x" * 199_999 + "y"), (None, "b"), (None, "alone"), (None, "alone")]
    return rows + [(200, "twice")] * 2 + [(201, "Twice"), (201, "twice")]


@pytest.mark.parametrize("collide", [False, True])
def test_equals_brute_force(spark, monkeypatch, collide):
    """With all texts of equal length sharing a fingerprint, the comparison parts them."""
    rows = table()
    df = spark.createDataFrame([(i, t, None, "s", 1, "x") for i, t in rows], SCHEMA + ", print string")
    if collide:
        real = poly_dedup._fingerprints

        def shortened(batch, real=real):
            import pyarrow as pa

            for b in real(batch):
                columns = dict(zip(b.schema.names, b.columns, strict=True))
                columns["print"] = pa.array([p[:8] for p in columns["print"].to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        monkeypatch.setattr(poly_dedup, "_fingerprints", shortened)
    got = poly_dedup.exact_groups(df).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_empty_table_and_query(spark):
    assert poly_dedup.exact_groups(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op7_poly_dedup"](spark, SF_SMALL).collect()), key=str) == brute(rows)
