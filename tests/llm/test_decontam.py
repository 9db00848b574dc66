"""Decontamination against a brute-force search for item windows."""

from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import decontam
from strata.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(doc: list[bytes], items: list[tuple[str | None, list[bytes]]], window: int) -> tuple[set[int], set[str]]:
    hit, found = set(), set()
    for item, ws in items:
        n = min(window, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            for j in range(len(doc) - n + 1):
                if doc[j : j + n] == ws[i : i + n]:
                    hit |= set(range(j, j + n))
                    found.add(item)
    return hit, found


WORDS = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=14)


@settings(max_examples=400, deadline=None)
@given(WORDS, st.lists(WORDS, max_size=5), st.integers(1, 5))
def test_automaton_equals_brute_force(doc, items, window):
    named = [(str(i), ws) for i, ws in enumerate(items)]
    runs, found = decontam.SuffixAutomaton(window).build(named).scan(doc)
    assert ({i for s, e in runs for i in range(s, e)}, found) == brute(doc, named, window)
    assert all(a[1] < b[0] for a, b in zip(runs, runs[1:], strict=False))


def expected(docs, items, window=10):
    named = [(str(i), decontam.words((t or "").encode())) for i, t in items]
    out = []
    for doc_id, text in docs:
        ws = decontam.words((text or "").encode())
        hit, found = brute(ws, named, window)
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(ws), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_words", [1_000_000, 40])
def test_digests_on_a_small_table(spark, block_words):
    rng = random.Random(3)
    vocabulary = ["Uno", "dos", "três", "x1", "Y", "zz"]
    items = [(i, " ".join(rng.choices(vocabulary, k=k))) for i, k in enumerate([12, 30, 4, 10, 1])] + [(9, None), (10, "")]
    docs = [(i, ", ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(30)]
    docs += [(50, "q " * 5000 + items[1][1].upper() + "!"), (51, None), (52, ""), (53, items[0][1]), (53, items[0][1]), (None, items[3][1])]
    rows = [(i, t, "en", None, 1) for i, t in docs]
    got = decontam.hit_digests(
        spark, spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string"), block_words=block_words
    )
    assert sorted(map(tuple, got.collect()), key=str) == expected(docs, items)


def test_query_equals_brute_force_on_contaminated_and_other_documents(spark):
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op9_decontaminate"](spark, SF_SMALL).collect()}
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(got) == sorted(d for d, _ in docs)
    windows = {tuple(w[i : i + 10]) for _, t in items for w in [decontam.words(t.encode())] for i in range(len(w) - 9)}
    short = min(len(decontam.words(t.encode())) for _, t in items)
    for doc_id, text in docs:
        ws = decontam.words((text or "").encode())
        if short >= 10:
            hit = {j for i in range(len(ws) - 9) if tuple(ws[i : i + 10]) in windows for j in range(i, i + 10)}
            assert got[doc_id][1:3] == (len(ws), len(hit))
    assert any(r[-1] for r in got.values()) and not all(r[-1] for r in got.values())


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontam.hit_digests(spark, docs, items).collect() == []
    one = spark.createDataFrame([(1, "a b", None, None, None)], SCHEMA)
    assert [tuple(r)[:4] for r in decontam.hit_digests(spark, one, items).collect()] == [(1, 2, 0, 0)]


def test_decontaminate_cuts_runs_and_drops_covered_documents(spark):
    item = "One two three four five six seven eight nine ten eleven"
    rows = [
        (1, f"before it {item}, after " + "w " * 30, "en", "s", 1, "x"),
        (2, item, "en", "s", 1, "x"),
        (3, None, None, None, None, None),
        (4, "clean text", "en", "s", 1, "x"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA + ", starts string")
    out = decontam.decontaminate(spark, docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert out.columns == docs.columns
    assert got == {1: "before it , after " + "w " * 30, 3: None, 4: "clean text"}
