"""The manifest against a plain tree built level by level, and its SQL."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import pytest

from strata.llm import merkle
from strata.llm.queries import QUERIES
from strata.llm.sql import SQL
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels_of(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def path(levels: list[list[str]], at: int) -> list[tuple[int, list[str]]]:
    out = []
    for nodes in levels[:-1]:
        first = at - at % 3
        run = nodes[first : first + 3]
        out.append((at - first, run[: at - first] + run[at - first + 1 :]))
        at //= 3
    return out


def brute(rows: list[tuple]) -> list[tuple]:
    """rows of (doc_id, text, lang, source, n_chars)."""
    trees: dict = {}
    for d, t, lang, s, n in rows:
        trees.setdefault(s, []).append((d, leaf(d, s, lang, n, t), (d, s, lang, n, t)))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for s in names:
        trees[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        built[s] = levels_of([x[1] for x in trees[s]])
    top = levels_of([built[s][-1][0] for s in names])
    out = []
    for i, s in enumerate(names):
        for at, (d, own, fields) in enumerate(trees[s]):
            steps = path(built[s], at) + path(top, i)
            shown = fields
            if d is not None and zlib.crc32(str(d).encode()) % 2 == 0 and fields[4] is not None:
                shown = (*fields[:4], fields[4].replace("\n", ""))
            folded = leaf(*shown)
            for place, others in steps:
                folded = sha("".join([*others[:place], folded, *others[place:]]))
            proof = sha("".join(o for _, others in steps for o in others))
            out.append((d, own, built[s][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=str)


def rows(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)
    names = ["hot"] * 6 + ["a", "b", "é", "", None]
    out = [(i, f"line {i}\nnext" if rng.random() < 0.6 else "one line", rng.choice(["en", None]), rng.choice(names), i) for i in range(n)]
    out += [(n, None, "en", "hot", None), (n + 1, "", "en", "only", 0), (None, "no\nid", "en", "hot", 1), (n + 2, "x\n" * 60_000, "en", "long", 1)]
    return out + [(n + 3, "same", "en", "hot", 1)] * 2 + [(n + 3, "other\n", "en", "hot", 1)]


@pytest.mark.parametrize(("n", "levels", "parts"), [(40, 1, 1), (300, 2, 13), (300, 1, 8), (2500, 6, 5)])
def test_equals_plain_tree(spark, n, levels, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame([(*r, "x", 5) for r in rows(n, n)], SCHEMA + ", tree string, at int")
        assert sorted(map(tuple, merkle.audit(df, levels).collect()), key=str) == brute(rows(n, n))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 80, 82])
def test_frontier_equals_levels(n):
    nodes = [sha(str(i)) for i in range(n)]
    frontier = merkle.Frontier()
    for x in nodes:
        frontier.append(x.encode())
    levels = levels_of(nodes)
    assert frontier.finish(merkle.depth(n)).decode() == levels[-1][0]
    for at, witness in enumerate(frontier.witnesses):
        assert [(p, [s.decode() for s in others]) for p, others in merkle.steps(bytes(witness))] == path(levels, at)
        assert merkle.fold(nodes[at].encode(), bytes(witness)).decode() == levels[-1][0]


def test_query_equals_plain_tree_and_sql(spark):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    got = sorted(map(tuple, QUERIES["op13_merkle_manifest"](spark, SF_SMALL).collect()), key=str)
    assert got == brute([tuple(r) for r in table.collect()])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    assert sorted(con.execute(SQL["op13_merkle_manifest"]).fetchall(), key=str) == got


def test_odd_rows_equal_sql(spark, tmp_dir):
    spark.createDataFrame(rows(3, 200), SCHEMA).write.parquet(f"{tmp_dir}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_dir}/documents.parquet/*.parquet'")
    got = sorted(map(tuple, QUERIES["op13_merkle_manifest"](spark, tmp_dir).collect()), key=str)
    assert sorted(con.execute(SQL["op13_merkle_manifest"]).fetchall(), key=str) == got


def test_manifest_keeps_its_own_outputs(spark):
    out = merkle.manifest(spark.createDataFrame(rows(5, 30), SCHEMA))
    assert out.columns == ["doc_id", "source", "leaf", "subroot", "root", "witness"]
    assert all(merkle.fold(r["leaf"].encode(), bytes(r["witness"])).decode() == r["root"] for r in out.collect())


def test_empty_table(spark):
    assert merkle.audit(spark.createDataFrame([], SCHEMA)).collect() == []
