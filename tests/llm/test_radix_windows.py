"""Repeated byte windows against a count of all windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from strata.llm import radix_windows
from strata.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows: list[tuple], length: int) -> list[tuple]:
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[i : i + length] for _, b in data for i in range(len(b) - length + 1))
    out = []
    for doc_id, b in data:
        covered = np.zeros(len(b) + 1, dtype=np.int8)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                covered[i : i + length] = 1
        kept = bytes(np.frombuffer(b, dtype=np.uint8)[covered[:-1] == 0])
        spans = int((np.diff(covered, prepend=0) == 1).sum())
        out.append((doc_id, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=str)


def made(seed: int, n: int, length: int) -> list[tuple]:
    """Texts over few letters, with shared passages, edits, periodic runs and copies."""
    rng = random.Random(seed)
    passages = ["".join(rng.choices("abcdé ", k=rng.randint(length // 2, 4 * length))) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = ["".join(rng.choices("abcdé ", k=rng.randint(0, 3 * length)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            if rng.random() < 0.5:
                at = rng.randrange(len(p))
                p = p[:at] + "#" + p[at + 1 :]
            parts += [p, "".join(rng.choices("abc", k=rng.randint(0, length)))]
        rows.append((i, "".join(parts)))
    rows += [(n, "x" * 3 * length), (n + 1, "xyz" * length), (n + 2, "y" * length), (n + 3, "y" * (length - 1))]
    rows += [(n + 4, None), (n + 5, ""), (None, rows[0][1]), (n + 6, rows[1][1]), (n + 6, rows[1][1]), (n + 7, "ab" * length + rows[2][1])]
    return rows


@pytest.mark.parametrize(("seed", "length", "parts"), [(1, 20, 8), (2, 20, 3), (3, 200, 8), (4, 37, 23)])
def test_equals_brute_force(spark, seed, length, parts):
    rows = made(seed, 40, length)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame([(i, t, None, "s", 1, "x") for i, t in rows], SCHEMA + ", found string")
        assert result(radix_windows.window_digests(df, length)) == brute(rows, length)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_hot_passage_over_many_partitions(spark):
    rng = random.Random(5)
    hot = "".join(rng.choices("abcdefgh ", k=90))
    rows = [(i, f"{rng.random()} {hot} {rng.random()}" if i % 3 else hot) for i in range(300)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 31)
    try:
        df = spark.createDataFrame([(i, t, None, "s", 1) for i, t in rows], SCHEMA)
        assert result(radix_windows.window_digests(df, 30)) == brute(rows, 30)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_text_longer_than_a_piece(spark, monkeypatch):
    rng = random.Random(6)
    base = "".join(rng.choices("abcdefgh", k=130_000))
    rows = [(1, base), (2, base[20_000:90_000] + "!" + base[:500]), (3, "q" * 1000 + base[48_000 - 100 : 48_000 + 150])]
    df = spark.createDataFrame([(i, t, None, "s", 1) for i, t in rows], SCHEMA)
    assert result(radix_windows.window_digests(df, 200)) == brute(rows, 200)


def test_empty_table(spark):
    assert radix_windows.window_digests(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert result(QUERIES["op5_radix_windows"](spark, SF_SMALL)) == brute(rows, 200)
