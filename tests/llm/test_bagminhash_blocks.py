"""Groups of several blocks are searched whole, also where their first blocks hold no link."""

from __future__ import annotations

import random

import pytest

from strata.llm import bagminhash
from tests.llm.test_bagminhash import SCHEMA, brute

BASE = [f"w{i}" for i in range(400)]


def changed(rng: random.Random, edits: int) -> str:
    words = list(BASE)
    for at in rng.sample(range(5, len(words) - 5, 5), edits):
        words[at] = f"edit{rng.random()}"
    return " ".join(words)


def family(seed: int) -> list[tuple]:
    """Two near texts, the last, which share each band with one of 40 lesser ones that are just
    below the threshold.  With seed 3 and blocks of one node neither is in a group's first block."""
    rng = random.Random(seed)
    lesser = [(i, changed(rng, 10)) for i in range(1, 41)]
    return [*lesser, (100, " ".join(BASE)), (101, changed(rng, 7))]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("nodes", [1, 512])
def test_classes_do_not_depend_on_the_number_of_blocks(spark, monkeypatch, nodes):
    monkeypatch.setattr(bagminhash, "BLOCK_NODES", nodes)
    rows = family(3)
    expected = brute(rows)
    assert [i for i, c in expected.items() if i != c] == [101]
    assert {r["doc_id"]: r["class_id"] for r in bagminhash.class_of_documents(table(spark, rows)).collect()} == expected
