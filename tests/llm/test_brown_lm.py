"""Counts and base score by brute force; the class model sums to one and beats the base on held-out texts."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from strata.llm import brown_lm
from strata.llm.queries import QUERIES
from tests.conftest import SF_MID, SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def split(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def check_base(rows, got):
    train = Counter(t for i, x in rows if zlib.crc32(str("" if i is None else i).encode()) % 10 for t in split(x))
    n, v = sum(train.values()), len(train)
    expected = []
    for doc_id, text in rows:
        ts = split(text)
        base = sum(math.log10((train[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts)
        out = zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 10 == 0
        expected.append((doc_id, out, len(ts), sum(train[t] > 0 for t in ts), n, base))
    key = lambda r: (str(r[0]), r[2], r[5])
    for a, b in zip(sorted(expected, key=key), sorted(got, key=key), strict=True):
        assert a[:5] == tuple(b)[:5]
        assert a[5] == pytest.approx(b["base_score"], rel=1e-9, abs=1e-9)


def test_query_on_all_documents(spark):
    got = QUERIES["op6_brown_lm"](spark, SF_MID).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()]
    check_base(rows, got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_words_beyond_the_broadcast_ones_and_odd_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    rows += [(None, "A b\x0bC d"), (1001, None), (1002, ""), (1003, "Same words same"), (1003, "Same words same"), (1004, "very long " * 30000)]
    df = spark.createDataFrame([(i, t, None, None, 1, "x") for i, t in rows], SCHEMA + ", words string")
    few = dict(top_words=50, endings=16, n_classes=6, rounds=2)
    got = brown_lm.score(df, known_words=120, **few).collect()
    check_base(rows, got)
    more = brown_lm.score(df, known_words=100_000, **few).collect()
    key = lambda r: (str(r["doc_id"]), r["n_tokens"], r["base_score"])
    assert [r["score"] for r in sorted(got, key=key)] == pytest.approx([r["score"] for r in sorted(more, key=key)])


def test_empty_table_and_no_training_text(spark):
    assert brown_lm.score(spark.createDataFrame([], SCHEMA)).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = brown_lm.score(spark.createDataFrame([(held, "a b", None, None, None)], SCHEMA)).collect()[0]
    assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (True, 3, 0, 0)
    assert row["base_score"] == pytest.approx(0.0) and math.isfinite(row["score"])


def test_probabilities_sum_to_one():
    words = [f"w{i}".encode() for i in range(9)]
    units = brown_lm.Units(words, list(range(9, 0, -1)), 3, 4)
    rng = np.random.default_rng(1)
    classes = np.r_[rng.integers(0, 2, 7), 2]
    of_unit = np.zeros(8)
    np.add.at(of_unit, units.unit, units.counts)
    of_unit[-1] = 5
    kinds = np.bincount(units.unit[3:] - 3, minlength=4)
    bigrams = rng.integers(0, 9, (3, 3)).astype(float)
    model = brown_lm.Model(units, (classes, bigrams, of_unit), 5, 45, 9, kinds)
    assert (10**model.transition).sum(1) == pytest.approx(np.ones(3))
    within = np.zeros(3)
    for unit in range(8):
        rare = 3 <= unit < 7
        mass = units.counts[units.unit == unit] + brown_lm.EXTRA if rare else [1.0]
        unseen = brown_lm.EXTRA if rare else 0.0
        within[classes[unit]] += 10 ** model.emission[unit] * (sum(mass) + unseen)
    assert within[np.unique(classes)] == pytest.approx(np.ones(len(np.unique(classes))))


def test_exchange_parts_words_that_never_meet():
    """Two vocabularies, each text from one of them: the classes do not mix them."""
    rng = np.random.default_rng(2)
    n, k = 40, 5
    pairs = np.zeros((n + 1, n + 1))
    for _ in range(3000):
        text = rng.integers(0, n // 2, 6) * 2 + rng.integers(0, 2)
        for a, b in zip(np.r_[n, text], np.r_[text, n], strict=True):
            pairs[a, b] += 1
    classes = np.r_[np.arange(n) % (k - 1), k - 1]
    classes = rng.permutation(classes[:-1])
    classes = np.r_[classes, k - 1]
    start = None
    for _ in range(6):
        one = np.eye(k)[classes]
        before, after = pairs.T @ one, pairs @ one
        start = start or brown_lm.likelihood(brown_lm.class_bigrams(after, classes, k))
        classes = brown_lm.sweep(before, after, classes, np.arange(n), k)
    end = brown_lm.likelihood(brown_lm.class_bigrams(pairs @ np.eye(k)[classes], classes, k))
    assert end > start
    assert not set(classes[:n:2]) & set(classes[1:n:2])
