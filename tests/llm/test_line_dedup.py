"""Line deduplication against a count over all lines, in both modes."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from strata.llm import line_dedup
from strata.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows: list[tuple], min_docs: int, keep_first: bool) -> list[tuple]:
    docs = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    where = defaultdict(list)
    for n, (_, text) in enumerate(docs):
        for at, key in enumerate(line_dedup.line_keys(text.encode())):
            if key:
                where[key].append((n, at))
    gone = set()
    for places in where.values():
        if len({n for n, _ in places}) >= min_docs:
            gone |= set(places[1:] if keep_first else places)
    number = {d: n for n, d in enumerate(docs)}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        n = number[doc_id, text or ""]
        kept = "\n".join(x for at, x in enumerate(lines) if (n, at) not in gone)
        out.append((doc_id, len(lines), sum((n, at) in gone for at in range(len(lines))), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("min_docs", "keep_first", "parts"), [(10, False, 8), (2, True, 8), (3, True, 37), (1, False, 2), (4, False, 1)])
def test_equals_brute_force(spark, min_docs, keep_first, parts):
    rng = random.Random(min_docs)
    pool = [f"Line {i}" for i in range(25)] + ["", " \t", "é É", "HOT", "hot ", "\x0bhot\r"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 12)) + ["Hot"] * (i % 3 > 0))) for i in range(70)]
    rows += [(100, None), (101, ""), (None, "Line 1\nhot\nown"), (102, "Line 2\nhot"), (102, "Line 2\nhot"), (103, "many\n" * 30_000 + "hot")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame([(i, t, None, "s", 1, "x") for i, t in rows], SCHEMA + ", positions string")
        got = line_dedup.line_digests(df, min_docs, keep_first).collect()
        assert sorted(map(tuple, got), key=str) == brute(rows, min_docs, keep_first)
        texts = line_dedup.drop_lines(df, min_docs, keep_first)
        assert texts.columns == df.columns
        shas = sorted(hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in texts.collect())
        assert shas == sorted(r["kept_sha256"] for r in got)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_bitmaps_hold_no_text_and_read_back(spark):
    docs = spark.createDataFrame([(i, f"common\nown {i}\ncommon", None, None, 1) for i in range(20)], SCHEMA)
    found = {r["doc_id"]: bytes(r["bitmap"]) for r in line_dedup.keep_bitmaps(docs, 2, True).collect()}
    assert line_dedup.kept_lines(b"common\nown 0\ncommon", found[0]) == (3, 1, b"common\nown 0")
    assert line_dedup.kept_lines(b"common\nown 5\ncommon", found[5]) == (3, 2, b"own 5")
    assert max(map(len, found.values())) < 20


def test_empty_table_and_query(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert line_dedup.line_digests(empty, 10, False).collect() == [] and line_dedup.drop_lines(empty).collect() == []
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op4_line_dedup"](spark, SF_SMALL).collect()), key=str) == brute(rows, 10, False)
