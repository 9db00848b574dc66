"""Spelling variants against all pairs compared by edits, and the SQL."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import spelling
from strata.llm.queries import QUERIES
from strata.llm.sql import SQL
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def edits(words) -> dict[str, set]:
    """Near words by masks: a letter left out, or replaced by a mark."""
    by_mask: dict = {}
    for w in words:
        by_mask.setdefault(w, set()).add(w)
        for i in range(len(w)):
            for mask in {w[:i] + w[i + 1 :], w[:i] + "?" + w[i + 1 :]}:
                by_mask.setdefault(mask, set()).add(w)
    out: dict = {w: set() for w in words}
    for mask, members in by_mask.items():
        if "?" in mask:
            for w in members:
                out[w] |= members - {w}
        elif mask in out:
            out[mask] |= members - {mask}
            for w in members - {mask}:
                out[w].add(mask)
    return out


def brute(rows: list[tuple]) -> list[tuple]:
    counts: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if c.isascii() else c for c in run)
            crc = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{low}".encode())
            counts[low if crc % 97 else low[: crc % len(low)] + low[crc % len(low) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = edits(words)
    form = {}
    for w, n in words.items():
        if near[w]:
            best = min(near[w], key=lambda v: (-words[v], v))
            if words[best] >= 2 * n:
                form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out, key=str)


def test_masks_equal_edits():
    rng = random.Random(1)
    words = sorted({"".join(rng.choices("abé", k=rng.randint(3, 7))) for _ in range(300)})
    near = edits(words)
    assert all((b in near[a]) == one_edit(a, b) for a in words for b in words if a != b)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abÿ", min_size=5, max_size=6), max_size=60), st.booleans())
def test_index_equals_edits(words, reverse):
    listed = sorted(words)
    for length in (5, 6):
        members = [w for w in listed if len(w) in (length, length + 1)]
        index = spelling.Index([w[::-1] for w in members] if reverse else members, length)
        for w in members:
            expected = {v for v in members if one_edit(v, w) and min(len(v), len(w)) == length}
            got = {v[::-1] if reverse else v for v in index.near(w[::-1] if reverse else w)}
            assert got == expected


def rows(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcdeéß", k=rng.randint(4, 12))) for _ in range(60)]

    def noisy(w: str) -> str:
        i = rng.randrange(len(w))
        return rng.choice([w, w, w, w[:i] + w[i + 1 :], w[:i] + "x" + w[i:], w[:i] + "y" + w[i + 1 :], w.upper()])

    out = [(i, " ".join(noisy(rng.choice(base[: rng.choice([5, 60])])) for _ in range(40))) for i in range(150)]
    out += [(500, None), (501, ""), (None, "null idea ideas ideas idea idea ideas ideas ideas"), (502, "hotword " * 60_000 + "hotwort " * 3)]
    return out + [(503, "repeat repeat-repeta3repeat")] * 3 + [(504, "a" * 40_000)] * 4 + [(505, "×÷àÀÿ " * 5 + "Àÿàÿà"), (506, "linkaa " * 5 + "linkab " * 12 + "linkbb " * 30)]


@pytest.mark.parametrize(("block", "parts"), [(1 << 14, 8), (7, 5), (1, 3)])
def test_equals_all_pairs(spark, block, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame([(i, t, "en", "s", 1, "x", 2) for i, t in rows(block)], SCHEMA + ", word string, n int")
        got = sorted(map(tuple, spelling.variants(df, block=block).collect()), key=str)
        assert got == brute(rows(block))
        assert ("linkaa", "linkab", "linkbb") in {r[:3] for r in got}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_query_equals_all_pairs_and_sql(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op11_spelling_variants"](spark, SF_SMALL).collect()), key=str)
    assert got == brute(table)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    assert sorted(con.execute(SQL["op11_spelling_variants"]).fetchall(), key=str) == got


def test_empty_table(spark):
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).collect() == []
