"""Mixing against its SQL on odd tables, the targets against resharing step by step, and emitted copies."""

from __future__ import annotations

import random

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import mixing
from strata.llm.queries import QUERIES
from strata.llm.sql import SQL
from tests.conftest import SF_MID

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def reshared(sizes: list[int], weights=(5, 2, 1), cap=3.0) -> list[float]:
    """Shares of the total by weight; what is above a cap is shared anew until none is."""
    left, out = float(sum(sizes)), [0.0] * len(sizes)
    free = set(range(len(sizes)))
    while free:
        whole = sum(weights[i % 3] for i in free)
        level = left / whole
        over = {i for i in free if level * weights[i % 3] > cap * sizes[i]}
        for i in over or free:
            out[i] = cap * sizes[i] if over else level * weights[i % 3]
        if not over:
            break
        left -= sum(out[i] for i in over)
        free -= over
    return out


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=9))
def test_targets_equal_resharing(spark_session, sizes):
    df = spark_session.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    assert [got[f"s{i}"] for i in range(len(sizes))] == pytest.approx(reshared(sizes))


@pytest.fixture(scope="module")
def spark_session(request):
    return request.getfixturevalue("spark")


def rows() -> list[tuple]:
    rng = random.Random(7)
    out = [(i, "w " * rng.randint(0, 40), "en", rng.choice(["a", "B", "é", "zz", None, "tiny"] + ["hot"] * 6), 1) for i in range(400)]
    out += [(1000, None, None, None, None), (1001, "", "en", "empty", 0), (None, "no id\x0bhere", "en", "a", 1), (1002, "x " * 90_000, "en", "long", 1)]
    return out + [(1003, "same row", "en", "a", 1)] * 2


def test_odd_rows_equal_sql(spark, tmp_dir):
    df = spark.createDataFrame([(*r, "x") for r in rows()], SCHEMA + ", target string")
    df.write.parquet(f"{tmp_dir}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_dir}/documents.parquet/*.parquet'")
    expected = sorted(con.execute(SQL["op8_mix_sources"]).fetchall(), key=str)
    got = sorted(map(tuple, QUERIES["op8_mix_sources"](spark, tmp_dir).collect()), key=str)
    assert got == expected and len(got) == len(rows())
    assert got == sorted(map(tuple, QUERIES["op8_mix_sources"](spark, tmp_dir).collect()), key=str)


def test_words_near_target_and_copies_emitted(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    mixed = mixing.mix_sources(docs)
    out = mixing.emit_copies(mixed)
    assert set(docs.columns) < set(out.columns)
    by_source = {r["source"]: r for r in mixed.groupBy("source").agg({"target": "max"}).collect()}
    taken = {r["source"]: r[1] for r in out.groupBy("source").agg({"size": "sum"}).collect()}
    assert all(abs(taken[source] / r[1] - 1) < 0.03 for source, r in by_source.items())
    copies = {r["doc_id"]: r["copies"] for r in mixed.collect()}
    assert max(copies.values()) <= 3
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {d: c for d, c in copies.items() if c}


def test_running_sums_over_slices(spark):
    rng = random.Random(2)
    values = [(i, rng.randint(0, 50)) for i in range(500)]
    df = spark.createDataFrame(values, "k long, v long").repartition(4)
    got = mixing.running_sums(df, [mixing.F.col("k").desc()], {"before": mixing.F.col("v")})
    assert {r["k"]: (r["before"], r["before_all"]) for r in got.collect()} == {k: (sum(v for j, v in values if j > k), sum(v for _, v in values)) for k, _ in values}


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_sources(empty).collect() == [] and mixing.emit_copies(mixing.mix_sources(empty)).collect() == []
