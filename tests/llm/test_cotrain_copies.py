"""A hot group of copies takes one place among the most confident texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.llm import cotrain
from strata.llm.common import text_tag


def test_copies_of_a_text_take_one_place(spark):
    docs = [(i, "the same text") for i in range(300)] + [(1000 + i, f"text {i}") for i in range(9)]
    rows = spark.createDataFrame([(i, t, "en", "s", 9) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    scored = rows.select("doc_id", text_tag().alias("tag")).withColumn("sure", F.when(F.col("doc_id") < 1000, 9.0).otherwise(F.col("doc_id") / 1000))
    for by, expected in ((-F.col("sure"), [1008, 1007, 1006, 1005]), (F.col("sure"), [1000, 1001, 1002, 1003, 1004])):
        got = [r["doc_id"] for r in cotrain.surest(scored, by, 5).collect()]
        assert len(got) == 5 and [i for i in got if i >= 1000] == expected


def test_rows_that_share_an_id_are_chosen_alike(spark):
    rows = [(i % 5, f"text {i}", "s", None if i % 3 else "en", i) for i in range(40)]
    schema = "doc_id long, text string, source string, lang string, n_chars long"
    picked = [
        sorted(map(tuple, cotrain.one_each(spark.createDataFrame(r, schema).repartition(n), "doc_id").collect()))
        for r, n in ((rows, 1), (rows[::-1], 7))
    ]
    assert picked[0] == picked[1] and [r[1] for r in picked[0]] == [min(t for d, t, *_ in rows if d == i) for i in range(5)]
