"""Held-out accuracy of the quality and toxicity scores, and odd input."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import cotrain
from strata.llm.queries import QUERIES
from tests.conftest import SF_MID, SF_SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    trained = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(3)) != 0)
    scored = cotrain.score(docs, trained).withColumnsRenamed({"quality": "p", "toxic": "p_toxic"})
    rows = scored.join(labels.join(trained, "doc_id", "left_anti"), "doc_id").collect()
    right = np.mean([(r["p"] >= 0.5) == bool(r["quality"]) for r in rows])
    # some labels call documents toxic that hold nothing toxic
    clean = np.mean([r["p_toxic"] < 0.5 for r in rows if not r["toxic"]])
    caught = np.mean([r["p_toxic"] >= 0.5 for r in rows if r["toxic"]])
    assert len(rows) > 100 and right > 0.95 and clean > 0.97 and caught > 0.5


def test_query_scores_every_document(spark):
    got = QUERIES["op3_cotraining"](spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert got.columns == ["doc_id", "quality", "toxic", "score", "kept"]
    rows = got.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs.collect())
    assert all(0 <= r["score"] <= 1 for r in rows) and {r["kept"] for r in rows} == {True, False}


def test_the_views_are_apart():
    """The text view does not see metadata, and the other one sees no words."""
    model = cotrain.Model({b"bad": 0})
    one, two = (model.features(t, s, "en", 9) for t, s in ((b"a bad text", "x"), (b"a bad text", "y")))
    assert one["content"] == two["content"] and one["metadata"] != two["metadata"]
    assert model.features(b"a new text", "x", "en", 9)["metadata"] == one["metadata"]


@pytest.mark.parametrize("value", [0, 1])
def test_one_class_only(spark, value):
    docs = spark.createDataFrame([(i, f"text {i}", "en", "s", 6) for i in range(40)], DOCS)
    labels = spark.createDataFrame([(i, value, value) for i in range(30)], LABELS)
    rows = cotrain.score(docs, labels).collect()
    assert all((r["quality"] > 0.9) == (r["toxic"] > 0.9) == bool(value) for r in rows)


def test_nulls_long_texts_repeats_and_no_labels(spark):
    rows = [(1, None, None, None, None), (None, "no id", "en", "s", 5), (2, "", "en", "s", 0), (3, "long word " * 50000, "en", None, -1), (3, "other", "x", "s", 5)]
    rows += [(4, "the same", "en", "s", 8)] * 2
    docs = spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", quality string")
    labels = spark.createDataFrame([(1, 1, None), (4, None, 0), (4, 0, 0), (None, 1, 1), (99, 0, 1)], LABELS)
    for some in (labels, labels.limit(0)):
        got = cotrain.score(docs, some).collect()
        assert len(got) == len(rows) and all(np.isfinite(r["score"]) for r in got)
    kept = cotrain.keep_good(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() in (0, len(rows))
    assert cotrain.score(docs.limit(0), labels).collect() == []
    assert cotrain.keep_good(docs.limit(0), labels).collect() == []
