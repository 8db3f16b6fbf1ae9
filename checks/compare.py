"""Run registered queries beside their SQL in DuckDB and compare the rows.

``python -m checks.compare [sf_dir] [name …]``
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES
from sootledger.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime) and v.time() == dt.time(0):
        return v.date()
    return v


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: [(x is None, str(type(x)), str(x)) for x in r])


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    got = _rows(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = _rows(names, cur.fetchall())
    out = []
    if sorted(df.columns) != sorted(names):
        out.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    if len(got) != len(want):
        out.append(f"{len(got)} rows != {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        out.append(f"{len(bad)} rows differ, first {bad[0]}")
    return out


def main(spark: SparkSession, sf_dir: str, wanted: list[str]) -> int:
    con, failed = database(sf_dir), 0
    for name in wanted or list(QUERIES):
        start = time.time()
        try:
            found = (
                differences(QUERIES[name](spark, sf_dir), con, ORACLES[name])
                if name in ORACLES
                else ["no SQL"]
            )
        except Exception as e:
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.2f}s", *found, sep="\n     ")
    print(f"{failed} failed of {len(wanted or QUERIES)}")
    return failed


if __name__ == "__main__":
    where = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(bool(main(local_session("compare"), where, sys.argv[2:])))
