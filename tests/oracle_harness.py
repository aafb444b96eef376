"""Run registered Spark queries next to their DuckDB oracle and compare
row count, column names and an order-insensitive hash of the values.

    python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def digest(pdf) -> tuple[int, list[str], str]:
    cols = sorted(pdf.columns)
    kinds = [f"{c}:{pdf[c].dtype}" for c in cols]
    rows = sorted("|".join(_norm(r[c]) for c in cols) for r in pdf[cols].to_dict("records"))
    return len(rows), kinds, hashlib.sha256("\n".join(rows).encode()).hexdigest()[:16]


def compare(spark, sf_dir: str, names=None) -> dict[str, dict]:
    import __spark_entry__ as se
    qs, sqls = se.queries(), se.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or sorted(qs):
        rec = {}
        t = time.time()
        try:
            sp = qs[name](spark, sf_dir).toPandas()
            rec["spark_s"] = round(time.time() - t, 2)
            rec["spark"] = digest(sp)
        except Exception as e:  # noqa: BLE001
            rec["spark_error"] = repr(e)[:400]
        if name in sqls:
            t = time.time()
            try:
                dd = con.execute(sqls[name]).df()
                rec["duck_s"] = round(time.time() - t, 2)
                rec["duck"] = digest(dd)
            except Exception as e:  # noqa: BLE001
                rec["duck_error"] = repr(e)[:400]
        rec["match"] = "spark" in rec and "duck" in rec and rec["spark"] == rec["duck"]
        out[name] = rec
        print("\nRESULT", name, rec, flush=True)
    return out


if __name__ == "__main__":
    from vantage.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if not v["match"]]
    print("MATCHED", len(res) - len(bad), "of", len(res), "mismatch:", bad)
