"""Repeated sentence spans against a scan over all spans in order."""

from __future__ import annotations

import random
import re

import pytest
import xxhash

from strata.llm import sentence_spans
from strata.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def split(text: str) -> list[tuple[int, int, tuple[str, ...]]]:
    """(start, end, words) of the sentences, character by character and without the library."""

    def pieces(start: int, end: int, marks: str) -> list[tuple[int, int]]:
        out, at, i = [], start, start
        while i < end:
            i += 1
            ends = text[i - 1] in marks and (i == end or text[i] in " \t\n\r\f\v" or text[i] in marks and text[i - 1] != "\n")
            if ends and text[i - 1] != "\n" and i < end and text[i] in marks:
                continue
            if ends or text[i - 1] == "\n":
                while i < end and text[i] in " \t\n\r\f\v":
                    i += 1
                out.append((at, i))
                at = i
        return out + [(at, end)] * (at < end)

    def words(start: int, end: int) -> tuple[str, ...]:
        return tuple(re.findall(r"[^ \t\n\r\f\v]+", "".join(c.lower() if c.isascii() else c for c in text[start:end])))

    out = []
    for start, end in pieces(0, len(text), ".!?"):
        if len(words(start, end)) <= 30:
            out.append((start, end, words(start, end)))
            continue
        for s, e in pieces(start, end, ",;:"):
            ws = words(s, e)
            if len(ws) <= 30:
                out.append((s, e, ws))
                continue
            places = [m.end() for m in re.finditer(r"\s*\S+\s*", text[s:e], re.A)]
            first, at = 0, s
            for i, w in enumerate(ws):
                if i + 1 == len(ws) or i + 1 - first == 30 or xxhash.xxh3_64_intdigest(w.encode()) % 8 == 0:
                    out.append((at, s + places[i], ws[first : i + 1]))
                    at, first = s + places[i], i + 1
    return [p for p in out if p[2]]


def brute(rows: list[tuple], min_sentences: int, min_words: int) -> list[tuple]:
    """Every run of enough sentences and words, of any length: all places but the first are cut."""
    docs = sorted({(i, t) for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, cuts = set(), {}
    for doc_id, text in docs:
        found = split(text or "")
        for first in range(len(found)):
            words, key = 0, ()
            for last in range(first, len(found)):
                words, key = words + len(found[last][2]), hash((key, found[last][2]))
                if last - first + 1 >= min_sentences and words >= min_words:
                    if key in seen:
                        cuts.setdefault((doc_id, text), set()).update(range(first, last + 1))
                    seen.add(key)
    out = []
    for doc_id, text in rows:
        found, gone = split(text or ""), cuts.get((doc_id, text), set())
        kept, at = "", 0
        for i, (start, end, _) in enumerate(found):
            if i in gone:
                kept, at = kept + text[at:start], end
        out.append((doc_id, len(found), len(gone), sum(len(found[i][2]) for i in gone), kept + (text or "")[at:]))
    return sorted(out, key=str)


def test_sentences():
    text = "One two.  Three!\nNo end\n\n4.5 is one? " + "w " * 20 + "a, " + "v " * 15 + "end"
    data = text.encode()
    got = [data[s:e] for s, e, *_ in sentence_spans.sentences(data)]
    assert got[:4] == [b"One two.  ", b"Three!\n", b"No end\n\n", b"4.5 is one? "]
    assert len(got) == 6 and b"".join(got) == data
    one, other = ([s[2] for s in sentence_spans.sentences(x)] for x in (b"A  b c. D", b"a b\tC. d"))
    assert one == other
    assert sentence_spans.sentences(b"") == sentence_spans.sentences(b" \n ") == []


@pytest.mark.parametrize(("seed", "parts"), [(1, 8), (2, 1), (3, 29)])
def test_equals_brute_force(spark, seed, parts):
    rng = random.Random(seed)
    pool = [" ".join(rng.choices("abcdefg", k=rng.randint(1, 6))) + rng.choice([". ", "! ", "\n"]) for _ in range(12)]
    rows = [(i, "".join(rng.choices(pool, k=rng.randint(0, 14)))) for i in range(50)]
    rows += [(60, None), (61, ""), (None, rows[3][1]), (7, rows[3][1]), (62, rows[4][1]), (62, rows[4][1]), (63, "word " * 20000 + ". ")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame([(i, t, None, "s", 1, "x") for i, t in rows], SCHEMA + ", cuts string")
        got = sentence_spans.drop_spans(df, 2, 6)
        # places of documents with equal doc_id are ordered by a hash of the text
        rows_ = [r for r in rows if r[0] != 7 or r[1] == rows[7][1]]
        if len(rows_) == len(rows):
            assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 2, 6)
        else:
            df = spark.createDataFrame([(i, t, None, "s", 1, "x") for i, t in rows_], SCHEMA + ", cuts string")
            assert sorted(map(tuple, sentence_spans.drop_spans(df, 2, 6).collect()), key=str) == brute(rows_, 2, 6)
            assert got.count() == len(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_empty_table(spark):
    assert sentence_spans.drop_spans(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op1_sentence_spans"](spark, SF_SMALL).collect()), key=str)
    assert got == brute(rows, 2, 20)
    assert any(r[2] for r in got)


def test_a_passage_of_over_fifty_words_goes_from_all_documents_but_the_first(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + ". "
    passage = "".join(sentence(n) for n in (9, 14, 4, 12, 15))
    rows = [(i, sentence(12) + sentence(8) + (passage if i % 3 == 0 else "") + sentence(10)) for i in range(30)]
    got = {r["doc_id"]: r for r in sentence_spans.drop_spans(spark.createDataFrame([(i, t, None, None, 1) for i, t in rows], SCHEMA)).collect()}
    for i, text in rows:
        assert got[i]["kept_text"] == (text.replace(passage, "") if i else text)
