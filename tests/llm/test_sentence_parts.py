"""Long passages without punctuation repeat by parts."""

from __future__ import annotations

import random

import pytest

from strata.llm import sentence_spans

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))


def run(spark, rows: list[tuple]) -> dict:
    return {r["doc_id"]: r for r in sentence_spans.drop_spans(spark.createDataFrame([(*r, None, None, 1) for r in rows], SCHEMA)).collect()}


@pytest.mark.parametrize("text", [words(random.Random(1), 5000), words(random.Random(2), 31)])
def test_an_exact_copy_of_a_text_of_one_sentence_goes(spark, text):
    got = run(spark, [(1, text), (2, text)])
    assert got[1]["kept_text"] == text and got[2]["kept_text"] == ""
    assert got[2]["n_words_removed"] == len(text.split())


def test_a_text_of_one_repeated_word(spark):
    got = run(spark, [(1, "same " * 5000), (2, "same " * 5000)])
    assert got[1]["kept_text"].startswith("same ") and got[2]["kept_text"] == ""  # the first place's own repeats go as well


def test_a_passage_within_unpunctuated_texts_goes_but_for_its_edges(spark):
    rng = random.Random(3)
    passage = words(rng, 300)
    rows = [(i, f"{words(rng, 100)} {passage} {words(rng, 100)}") for i in range(4)]
    got = run(spark, rows)
    assert got[0]["kept_text"] == rows[0][1]
    for i, text in rows[1:]:
        left = got[i]["kept_text"].split()
        own = [w for w in text.split() if w not in set(passage.split())]
        assert [w for w in left if w not in set(passage.split())] == own
        assert 200 <= len(left) <= 260


def test_parts_cover_the_text_and_are_short():
    text = ("\t " + words(random.Random(4), 400) + "  \n" + words(random.Random(5), 20) + ". end").encode()
    found = sentence_spans.sentences(text)
    assert b"".join(text[s:e] for s, e, *_ in found) == text
    assert max(n for *_, n in found) <= sentence_spans.LONG and sum(n for *_, n in found) == 421
