"""Near-duplicate classes against all pairs; the signature's estimate against the exact similarity."""

from __future__ import annotations

import random

import numpy as np
import pytest

from strata.llm import bagminhash
from strata.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows: list[tuple], threshold: float = 0.8) -> dict:
    """doc_id -> least doc_id of its component, from all pairs of different texts."""
    sets = {(i, t): bagminhash.multiset((t or "").encode(), 5) for i, t in rows}
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = list(sets)
    for n, a in enumerate(keys):
        for b in keys[:n]:
            if len(sets[a][0]) and len(sets[b][0]):
                small, large = sorted((sets[a][1].sum(), sets[b][1].sum()))
                if small >= threshold * large and bagminhash.similarity(sets[a], sets[b]) >= threshold:
                    x, y = sorted((root(a[0]), root(b[0])))
                    parent[y] = x
    return {i: root(i) for i, _ in rows}


def test_estimate_is_unbiased_for_weighted_similarity():
    rng = np.random.default_rng(1)
    elements = rng.integers(0, 2**63, 300, dtype=np.uint64)
    a = rng.integers(0, 9, 300) ** rng.integers(1, 3, 300)
    b = np.where(rng.random(300) < 0.7, a, rng.integers(0, 40, 300))
    exact = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    m = 4096
    one, two = (bagminhash.bag_minhash(elements[w > 0], w[w > 0], m) for w in (a, b))
    assert abs((one == two).mean() - exact) < 4 * (exact * (1 - exact) / m) ** 0.5
    assert (one == bagminhash.bag_minhash(elements[a > 0][::-1], a[a > 0][::-1], m)).all()
    tiny = bagminhash.bag_minhash(elements[:1], np.array([1]), 128)
    assert np.isfinite(tiny).all() and len(np.unique(tiny)) == 128


def test_shingles_of_short_and_repeating_texts():
    words = bagminhash.word_list(b"A b\tc  D e F")
    assert words == [b"a", b"b", b"c", b"d", b"e", b"f"]
    assert len(bagminhash.shingles(words, 5)) == 2 and len(bagminhash.shingles(words[:3], 5)) == 1
    assert len(bagminhash.shingles([], 5)) == 0
    elements, counts = bagminhash.multiset(b"x " * 20, 5)
    assert list(counts) == [16]
    assert bagminhash.similarity((elements, counts), (elements, counts // 2)) == 0.5


def edited(rng: random.Random, words: list[str], edits: int) -> str:
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.random()}"
    return " ".join(words)


def test_block_equals_pairwise_similarity():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 40, rng.integers(1, 60)).astype(np.uint64), return_counts=True) for _ in range(50)]
    block = bagminhash.Block([(i, i) for i in range(50)], sets)
    for threshold in (0.3, 0.6):
        for elements, counts in [*sets, (np.array([7], np.uint64), np.array([3])), (np.array([99], np.uint64), np.array([1]))]:
            expected = [i for i, other in enumerate(sets) if bagminhash.similarity((elements, counts), other) >= threshold]
            assert block.similar(elements, counts, threshold).tolist() == expected


@pytest.mark.parametrize(("nodes", "words", "queries"), [(512, 2_000_000, 1024), (4, 2_000_000, 3), (512, 500, 1024)])
def test_classes_equal_all_pairs(spark, monkeypatch, nodes, words, queries):
    """Chains, a group whose members are partly not similar, copies, and odd rows."""
    for name, value in (("BLOCK_NODES", nodes), ("BLOCK_WORDS", words), ("QUERIES", queries)):
        monkeypatch.setattr(bagminhash, name, value)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, n = [], 0
    for size, length, edits in ((40, 200, 6), (25, 120, 3), (12, 80, 4), (5, 400, 3), (3, 30, 1)):
        base = rng.choices(vocabulary, k=length)
        for _ in range(size):
            rows.append((n := n + 1, edited(rng, base, rng.randint(0, edits))))
    chain = rng.choices(vocabulary, k=300)
    for i in range(12):  # each similar to the next only
        rows.append((n := n + 1, " ".join(chain)))
        chain[i * 23 : i * 23 + 18] = rng.choices(vocabulary, k=18)
    rows += [(n + i, " ".join(rng.choices(vocabulary, k=60))) for i in range(1, 20)]
    rows += [(500, rows[0][1].upper()), (501, rows[0][1]), (501, rows[0][1]), (502, None), (503, ""), (504, " \n"), (505, "one"), (506, "One ")]
    rows += [(507, "very long " * 40000), (508, "very long " * 40001)]
    df = spark.createDataFrame([(i, t, None, "s", 1, "x") for i, t in rows], SCHEMA + ", class string")
    got = bagminhash.class_of_documents(df).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["class_id"] for r in got} == brute(rows)


def test_null_ids_repeated_ids_and_kept_rows(spark):
    long_ = " ".join(f"t{i}" for i in range(50))
    rows = [(1, long_), (None, long_ + " more"), (None, "else where no copy at all"), (2, "x y z"), (2, long_), (3, "x y z"), (4, None), (4, None)]
    df = spark.createDataFrame([(i, t, None, "s", 1, "x") for i, t in rows], SCHEMA + ", _key string")
    got = bagminhash.class_of_documents(df).collect()
    assert sorted(r["class_id"] for r in got)[:-1] == [1, 1, 1, 1, 1, 4, 4]
    kept = bagminhash.keep_one_per_class(df)
    assert kept.columns == df.columns
    # the second row of doc_id 2 is a copy of the first document's text, its first row is 3's
    assert sorted((str(r["doc_id"]), str(r["text"])[:5]) for r in kept.collect()) == [("1", "t0 t1"), ("3", "x y z"), ("4", "None"), ("None", "else ")]


def test_empty_table(spark):
    assert bagminhash.class_of_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    assert bagminhash.keep_one_per_class(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_equals_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op2_bagminhash"](spark, SF_SMALL).collect()}
    assert got == brute(rows)


def test_documents_of_several_texts_keep_their_links(spark):
    """A document's texts differ in length and distance, and each may link it."""
    rng = random.Random(8)
    one, two = ([f"{n}{i}" for i in range(200)] for n in "ab")
    rows = [(1, " ".join(one)), (1, " ".join(two[:60])), (2, edited(rng, one, 3)), (3, edited(rng, two[:60], 1)), (4, " ".join(two))]
    got = bagminhash.class_of_documents(spark.createDataFrame([(i, t, None, None, 1) for i, t in rows], SCHEMA)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == brute(rows) == {1: 1, 2: 1, 3: 1, 4: 4}
