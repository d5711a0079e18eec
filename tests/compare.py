"""Run registered queries against their SQL form in DuckDB.

    python tests/compare.py [--sf 0.01] [--time] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb
import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    return con


def canon(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, (list, tuple, np.ndarray)):
        return tuple(canon(v) for v in x)
    if isinstance(x, Decimal):
        return float(x)
    if isinstance(x, (bool, np.bool_)):
        return bool(x)
    if isinstance(x, (int, np.integer)):
        return int(x)
    if isinstance(x, (float, np.floating)):
        return round(float(x), 9)
    return str(x)


def kind(t: str) -> str:
    t = t.lower()
    for names, k in (
        (("bigint", "int64", "hugeint"), "i64"),
        (("integer", "int32", "int"), "i32"),
        (("double", "float64"), "f64"),
        (("float",), "f32"),
        (("varchar", "string"), "str"),
        (("boolean",), "bool"),
        (("decimal",), "decimal"),
        (("timestamp",), "ts"),
        (("date",), "date"),
    ):
        if t.startswith(names) and not t.endswith("[]"):
            return k
    return t


def compare(spark, con, root: str, name: str, fn, sql: str | None):
    t0 = time.time()
    df = fn(spark, root)
    got = [tuple(r) for r in df.collect()]
    secs = time.time() - t0
    cols = df.columns
    if sql is None:
        return ("rows", f"{len(got)} rows", secs)
    rel = con.execute(sql)
    desc = {d[0]: kind(str(d[1])) for d in rel.description}
    want = rel.fetchall()
    wcols = list(desc)
    if sorted(cols) != sorted(wcols):
        return ("FAIL", f"columns {sorted(cols)} != {sorted(wcols)}", secs)
    types = {c: kind(t) for c, t in df.dtypes}
    warn = [f"{c}:{types[c]}/{desc[c]}" for c in cols if types[c] != desc[c]]
    order = sorted(cols)
    gi, wi = [cols.index(c) for c in order], [wcols.index(c) for c in order]
    key = lambda r: tuple((v is None, str(type(v)), v) for v in r)
    a = sorted((tuple(canon(r[i]) for i in gi) for r in got), key=key)
    b = sorted((tuple(canon(r[i]) for i in wi) for r in want), key=key)
    if len(a) != len(b):
        only_a = [r for r in a if r not in set(b)][:1]
        only_b = [r for r in b if r not in set(a)][:1]
        return ("FAIL", f"rows {len(a)} != {len(b)}; only spark {str(only_a)[:600]}; only sql {str(only_b)[:600]}", secs)
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        return ("FAIL", f"{len(diff)}/{len(a)} rows differ ({order}), first:\n   {str(diff[0][0])[:700]}\n   {str(diff[0][1])[:700]}", secs)
    if not a:
        return ("EMPTY", "0 rows", secs)
    return ("ok", f"{len(a)} rows" + (f" TYPES {warn}" if warn else ""), secs)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    import __spark_entry__ as entry

    from corpusloom.session import local_session

    root = f"/root/testdata/sf{args.sf}"
    spark = local_session()
    con = oracle_connection(root)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    names = args.names or list(qs)
    names = [n for n in qs if any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in names)]
    for name in names:
        try:
            state, text, secs = compare(spark, con, root, name, qs[name], sqls.get(name))
        except Exception as e:  # report and go on
            state, text, secs = "ERROR", str(e)[:900], 0.0
        bad += state in ("FAIL", "ERROR", "EMPTY")
        print(f"{state:6} {name:32} {secs:6.2f}s {text}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
