"""Links that the signatures miss are found all the same."""

from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from strata.llm import bagminhash
from tests.llm.test_bagminhash import SCHEMA, brute, edited

NONE = (np.empty(0, np.uint64), np.empty(0, np.int64))


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)


def missed_pair() -> list[tuple]:
    """Two texts of similarity 0.8, the last five words of 49 changed, that share none of the 25 bands."""
    words = [f"w82593x{i}" for i in range(49)]
    return [(1, " ".join(words)), (2, " ".join(words[:44] + [f"e82593y{i}" for i in range(5)]))]


def band_set(text: str) -> set:
    return set(bagminhash.band_keys(bagminhash.bag_minhash(*bagminhash.multiset(text.encode(), 5), 125), 25).tolist())


def test_the_pipeline_stage_finds_a_pair_without_a_common_band(spark):
    rows = missed_pair()
    assert bagminhash.similarity(*(bagminhash.multiset(t.encode(), 5) for _, t in rows)) == 0.8
    assert not band_set(rows[0][1]) & band_set(rows[1][1])
    assert [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, table(spark, rows), "unused").collect()] == [1]


@pytest.mark.parametrize(("nodes", "sample", "threshold"), [(512, 10_000, 0.8), (3, 5, 0.8), (512, 10_000, 0.5)])
def test_classes_equal_all_pairs_where_signatures_find_next_to_nothing(spark, monkeypatch, nodes, sample, threshold):
    """One band of 40 registers; families of copies, a line that most texts hold, repeats, several texts of an id."""
    monkeypatch.setattr(bagminhash, "BLOCK_NODES", nodes)
    monkeypatch.setattr(bagminhash, "SAMPLE", sample)
    rng = random.Random(4)
    line = " ".join(f"c{i}" for i in range(30))
    rows, n = [], 0
    for size, length, edits in ((30, 200, 8), (15, 60, 2), (10, 20, 1), (6, 4, 1)):
        base = [f"b{length}x{rng.randrange(40)}" for _ in range(length)]
        rows += [(n := n + 1, f"{edited(rng, base, rng.randint(0, edits))} {line if rng.random() < 0.6 else ''}") for _ in range(size)]
    rows += [(n := n + 1, "ab cd " * k) for k in (3, 9, 10, 12, 200, 240, 300)]
    rows += [(5, "ab cd " * 11), (40, None), (60, ""), (200, "one"), (201, "ONE"), (202, rows[0][1].upper())]
    got = bagminhash.class_of_documents(table(spark, rows), threshold=threshold, bands=1, rows=40).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == brute(rows, threshold)


def test_similar_multisets_share_a_first_shingle_in_any_order():
    rng = np.random.default_rng(6)
    for _ in range(300):
        elements = rng.integers(0, 2**63, 30, dtype=np.uint64)
        a = rng.integers(0, 6, 30)
        b = np.maximum(0, a + rng.integers(-1, 2, 30) * (rng.random(30) < 0.4))
        one, two = ((np.sort(elements)[w > 0], w[w > 0]) for w in (a, b))
        seen = np.sort(rng.choice(bagminhash.numbered_shingles(*one), 10, replace=False))
        similarity = bagminhash.similarity(one, two)
        for common in (NONE, (seen, rng.integers(1, 2**40, 10))):
            first = [bagminhash.prefix(*x, similarity, common) for x in (one, two)]
            assert len(np.intersect1d(*first))


def test_registers_do_not_depend_on_where_processes_were_cut():
    """Registers that agree but for rounding agree to the last bit, for repeats of different number."""
    for n, m in ((1000, 1250), (40_000, 48_000)):
        one, two = (bagminhash.bag_minhash(*bagminhash.multiset(b"very long " * k, 5), 125) for k in (n, m))
        assert ((one == two) == np.isclose(one, two, rtol=1e-9, atol=0)).all()
