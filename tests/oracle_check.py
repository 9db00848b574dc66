"""Compare ``queries()`` against ``oracle_sql()`` the way the driver does (row count,
column names, order-insensitive values).  Usable from pytest and from the shell:

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

import duckdb  # noqa: E402

import os as _os

# STRATA_CHECK_EXACT=1 compares floats bit for bit (the driver may hash them unrounded)
EXACT = _os.environ.get("STRATA_CHECK_EXACT") == "1"

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(v) if EXACT else round(float(v), 6)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def rows_spark(df) -> tuple[list[str], list[tuple]]:
    cols = sorted(df.columns, key=str.lower)
    data = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return [c.lower() for c in cols], sorted(data, key=_key)


def rows_duck(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    data = cur.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    rows = [tuple(_norm(r[i]) for i in order) for r in data]
    return [names[i].lower() for i in order], sorted(rows, key=_key)


# Spark type name -> DuckDB type name, for the schema comparison
SPARK_TO_DUCK = {
    "tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT", "float": "FLOAT",
    "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE", "boolean": "BOOLEAN",
}


def types_spark(df) -> dict[str, str]:
    return {c.lower(): SPARK_TO_DUCK.get(t, t.upper()) for c, t in df.dtypes}


def types_duck(con, sql: str) -> dict[str, str]:
    rel = con.sql(sql)
    return {c.lower(): str(t) for c, t in zip(rel.columns, rel.types)}


def compare(spark, sf_dir: str, name: str, query, sql: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    df = query(spark, sf_dir)
    sc, sr = rows_spark(df)
    t1 = time.time()
    dc, dr = rows_duck(con, sql)
    out = {"name": name, "spark_rows": len(sr), "oracle_rows": len(dr), "spark_sec": round(t1 - t0, 2)}
    st, dt = types_spark(df), types_duck(con, sql)
    out["types_match"] = st == dt
    if not out["types_match"]:
        out["type_diff"] = {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
    out["columns_match"] = sc == dc
    out["values_match"] = sr == dr
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = sc, dc
    elif not out["values_match"]:
        diff_s = [r for r in sr if r not in set(dr)][:3]
        diff_d = [r for r in dr if r not in set(sr)][:3]
        out["only_spark"], out["only_oracle"] = diff_s, diff_d
    return out


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from strata.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session()
    import os

    if os.environ.get("STRATA_CHECK_TZ"):  # results must not depend on the session time zone
        spark.conf.set("spark.sql.session.timeZone", os.environ["STRATA_CHECK_TZ"])
    if os.environ.get("STRATA_CHECK_NO_AQE"):  # nor on adaptive execution
        spark.conf.set("spark.sql.adaptive.enabled", "false")
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            print(f"{name:32s} rows-only  n={df.count()}")
            continue
        try:
            r = compare(spark, sf_dir, name, qs[name], sqls[name], con)
        except Exception as exc:  # report and continue
            bad += 1
            print(f"{name:32s} ERROR {type(exc).__name__}: {str(exc)[:400]}")
            continue
        ok = r["columns_match"] and r["values_match"] and r["types_match"]
        bad += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} spark={r['spark_rows']} oracle={r['oracle_rows']} {r['spark_sec']}s"
              + ("" if ok else f" {dict((k, v) for k, v in r.items() if k not in ('name',))}"))
    print("mismatches:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
