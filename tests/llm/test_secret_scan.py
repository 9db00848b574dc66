"""Secret scans against plain loops over every window, their SQL, planted secrets and the allow list."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import uuid
from collections import Counter

import duckdb
import pytest

from strata.llm import secret_scan
from strata.llm.queries import QUERIES
from strata.llm.sql import SQL
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
HELD = {"entropy_hex": ("0-9A-Fa-f", 3.0), "entropy_alnum": ("A-Za-z0-9", 3.7), "entropy_base64": ("A-Za-z0-9+/_-", 3.7)}


def entropy(window: str) -> float:
    return -sum(c / len(window) * math.log2(c / len(window)) for c in Counter(window).values())


def holds(kind: str, window: str) -> bool:
    digits, upper, lower = (sum(a <= c <= z for c in window) for a, z in ("09", "AZ", "az"))
    if kind == "entropy_hex":
        return digits >= 3 and upper + lower >= 3
    if kind == "entropy_alnum":
        return digits >= 2 and upper + lower >= 2
    return digits >= 2 and upper >= 2 and lower >= 2


def brute(rows: list[tuple]) -> list[tuple]:
    out = []
    for doc_id, text in rows:
        text = text or ""
        spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
        off = []
        for rank, (kind, (chars, bits)) in reversed(list(enumerate(HELD.items(), 3))):  # the widest first
            last = 0
            for m in re.finditer(f"[{chars}]{{20,}}", text):
                run, head, last = m.group(), text[last : m.start()], m.end()
                if re.search(secret_scan.ALLOWED, run) or re.search(secret_scan.ALLOWED_BEFORE[:-1] + r"\Z", head[-24:]):
                    off += [m.span()] * (rank == 5)
                    continue
                if any(a <= m.start() < b for a, b in off):
                    continue
                hot = [i for i in range(len(run) - 19) if holds(kind, run[i : i + 20]) and entropy(run[i : i + 20]) >= bits - 1e-6]
                if hot:
                    spans.append((m.start() + hot[0], rank, m.start() + hot[-1] + 20))
        spans.sort()
        names = [f"{secret_scan.KINDS[r]}:{a}:{b}" for a, r, b in spans]
        base = [n for n, (_, r, _) in zip(names, spans, strict=True) if r < 3]
        n = Counter(r for _, r, _ in spans)
        out.append((doc_id, n[0], n[1], n[2], n[3] + n[4] + n[5], hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(names)))
    return sorted(out, key=str)


def blob(rng: random.Random, n: int) -> str:
    return base64.b64encode(rng.randbytes(n)).decode()


def rows(seed: int = 4) -> list[tuple]:
    rng = random.Random(seed)
    pieces = [
        lambda: f"token = \"{rng.randbytes(20).hex()}\"",
        lambda: f"PASSWORD:'{blob(rng, 9)}'",
        lambda: "api_key=short",
        lambda: "apikey : " + "AKIA" + "".join(rng.choices("ABCDXYZ0123456789", k=rng.randint(8, 16))),
        lambda: f"secret={blob(rng, rng.randint(6, 60))}",
        lambda: f"sha256:{rng.randbytes(32).hex()}",
        lambda: f"commit {rng.randbytes(20).hex().upper()}",
        lambda: str(uuid.UUID(bytes=rng.randbytes(16))),
        lambda: "EXAMPLE" + blob(rng, 18),
        lambda: "token: secret: abcdefghijkl",
        lambda: "token=token=abcdefghijk",
        lambda: "123456789012345678901234567890123456",
        lambda: "Donaudampfschifffahrtsgesellschaft éèà \U0001f600",
        lambda: "deadbeef" * rng.randint(3, 6),
        lambda: "a1" * 20,
    ]
    out = [(i, rng.choice(["", "é\n", "\U0001f600 "]).join(rng.choice(pieces)() + rng.choice([" ", "\n", ""]) for _ in range(rng.randint(0, 9)))) for i in range(250)]
    out += [(900, None), (901, ""), (None, "token=abcdefgh"), (902, "token=abcdefgh é " * 1500), (903, blob(rng, 9000)), (904, "é" * 70_000 + rng.randbytes(3000).hex())]
    return out + [(905, "secret=12345678")] * 3 + [(906, "toKen=abcdefgh Key token=ſecret=abcdefgh")]


def test_equals_plain_loops_and_sql(spark, tmp_dir):
    df = spark.createDataFrame([(i, t, "en", "s", 1, "x") for i, t in rows()], SCHEMA + ", secrets string")
    df.write.parquet(f"{tmp_dir}/documents.parquet")
    got = sorted(map(tuple, QUERIES["op12_secret_scan"](spark, tmp_dir).collect()), key=str)
    assert got == brute(rows())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_dir}/documents.parquet/*.parquet'")
    assert sorted(con.execute(SQL["op12_secret_scan"]).fetchall(), key=str) == got


def test_query_equals_plain_loops(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op12_secret_scan"](spark, SF_SMALL).collect()), key=str) == brute(table)


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 1000])
def test_running_sums(spark, n):
    from pyspark.sql import functions as F

    values = [(i * 7919) % 13 for i in range(n)]
    df = spark.createDataFrame([(values,)], "v array<bigint>")
    sums = [sum(values[: i + 1]) for i in range(n)]
    assert df.select(secret_scan.running_sums(F.col("v"))).first()[0] == sums


def test_planted_are_found_and_prose_is_left_alone(spark):
    rng = random.Random(9)
    planted = [f"see {kind} here" for kind in (rng.randbytes(16).hex(), blob(rng, 24), "ghp_" + "".join(rng.choices("abcXYZ0189kLmN", k=36)))]
    clean = ["Donaudampfschifffahrtsgesellschaftskapitän 1234567890123456789012", "a/long/path/of/words/without/any-number", "https://host/" + "word-" * 9]
    allowed = [f"md5: {rng.randbytes(16).hex()}", "key 0123456789abcdefghij01234", "data:image/png;base64," + blob(rng, 400)]
    df = spark.createDataFrame(list(enumerate(planted + clean + allowed)), "doc_id long, text string")
    found = {r["doc_id"]: r["n_entropy"] for r in secret_scan.secret_digests(df).collect()}
    assert [found[i] > 0 for i in range(9)] == [True] * 3 + [False] * 6


def test_redact(spark):
    text = "é token=abcdefgh12 and " + "0123abcd" * 4 + " end"
    out = secret_scan.redact(spark.createDataFrame([(1, text, 7), (2, "clean", 8), (3, None, 9)], "doc_id long, text string, secrets int"))
    assert sorted(map(tuple, out.collect())) == [(1, "é [SECRET] and [SECRET] end", 7), (2, "clean", 8), (3, None, 9)]


def test_no_python_in_the_plan(spark):
    plan = secret_scan.secret_digests(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Exchange" not in plan


def test_empty_table(spark):
    assert secret_scan.secret_digests(spark.createDataFrame([], SCHEMA)).collect() == []
