"""Repeated sentence runs of every length against a scan over all runs, not only the shortest from each start."""

from __future__ import annotations

import random

import pytest

from strata.llm import sentence_spans

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows: list[tuple], min_sentences: int, min_words: int) -> list[tuple]:
    """Every run of enough sentences and words: all places but the first are cut."""
    seen, out = set(), []
    for doc_id, text in rows:
        data = text.encode()
        found, gone = sentence_spans.sentences(data), set()
        for first in range(len(found)):
            for last in range(first + min_sentences - 1, len(found)):
                if sum(s[3] for s in found[first : last + 1]) >= min_words:
                    key = tuple(s[2] for s in found[first : last + 1])
                    if key in seen:
                        gone.update(range(first, last + 1))
                    seen.add(key)
        kept, at = b"", 0
        for i, (start, end, *_) in enumerate(found):
            if i in gone:
                kept, at = kept + data[at:start], end
        out.append((doc_id, len(found), len(gone), sum(found[i][3] for i in gone), (kept + data[at:]).decode()))
    return sorted(out)


def run(spark, rows: list[tuple], *limits: int) -> list[tuple]:
    return sorted(map(tuple, sentence_spans.drop_spans(spark.createDataFrame([(*r, None, None, 1) for r in rows], SCHEMA), *limits).collect()))


def test_the_last_sentences_of_a_repeated_run_go_too(spark):
    sentence = lambda word, n: " ".join([word] * n) + ". "
    shared = sentence("a", 15) + sentence("b", 10) + sentence("c", 9)
    rows = [(1, shared + sentence("d", 12)), (2, shared + sentence("e", 12))]
    assert run(spark, rows) == [(1, 4, 0, 0, rows[0][1]), (2, 4, 3, 34, sentence("e", 12))]


@pytest.mark.parametrize(("seed", "limits"), [(1, (2, 6)), (2, (2, 15)), (3, (3, 9)), (4, (1, 4))])
def test_equals_a_scan_over_all_runs(spark, seed, limits):
    rng = random.Random(seed)
    pool = [" ".join(rng.choices("abcdefg", k=rng.randint(1, 9))) + rng.choice([". ", "! ", "\n"]) for _ in range(12)]
    rows = [(i, "".join(rng.choices(pool, k=rng.randint(0, 14)))) for i in range(60)]
    assert run(spark, rows, *limits) == brute(rows, *limits)
