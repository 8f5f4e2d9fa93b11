"""Compare a query's Spark result with its DuckDB oracle SQL.

Usable from pytest (``compare``) and as a script:
    python tests/oracle.py [--sf DIR] [--tz ZONE] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _kind(dtype) -> str:
    k = getattr(dtype, "kind", "O")
    if k in "iu":
        return "int"
    if k == "f":
        return "float"
    if k == "b":
        return "bool"
    if k == "M":
        return "datetime"
    return "object"


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        if v == 0:
            v = 0.0
        return repr(float(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    # whole numbers with NULLs: Spark's come as floats, DuckDB's as nullable integers
    pdf = pdf.astype({c: "float64" for c in cols if pdf[c].dtype.name == "Int64" and pdf[c].isna().any()})
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(None if (isinstance(x, float) and math.isnan(x)) or x is pd.NaT or x is None
                                   else x) for x in rec))
    return sorted(out)


# Spark simple type name -> DuckDB type name
SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from tessera.plans.catalog import ORACLE, QUERIES

    con = con or duck(sf_dir)
    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    sdf = df.toPandas()
    t1 = time.time()
    rel = con.sql(ORACLE[name])
    otypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    odf = rel.df()
    res = {"name": name, "spark_sec": round(t1 - t0, 2), "rows": (len(sdf), len(odf))}
    res["type_diff"] = {c: (stypes.get(c), otypes.get(c)) for c in set(stypes) | set(otypes)
                        if SQL_TYPES.get(stypes.get(c), stypes.get(c)) != otypes.get(c)}
    res["cols_ok"] = sorted(sdf.columns) == sorted(odf.columns)
    if not res["cols_ok"]:
        res["cols"] = (sorted(sdf.columns), sorted(odf.columns))
        res["ok"] = False
        return res
    kinds = {c: (_kind(sdf[c].dtype), _kind(odf[c].dtype)) for c in sdf.columns}
    res["kind_diff"] = {c: k for c, k in kinds.items() if k[0] != k[1]}
    a, b = rows_of(sdf), rows_of(odf)
    res["values_ok"] = a == b
    if not res["values_ok"]:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["first_diffs"] = diff
    res["ok"] = (res["cols_ok"] and res["values_ok"] and len(sdf) == len(odf) and not res["kind_diff"]
                 and not res["type_diff"])
    return res


def main(argv: list[str]) -> int:
    from tessera.plans.catalog import ORACLE
    from tessera.session import local_session

    sf_dir, tz = "/root/testdata/sf0.01", None
    while argv[:1] in (["--sf"], ["--tz"]):
        if argv[0] == "--sf":
            sf_dir = argv[1]
        else:
            tz = argv[1]
        argv = argv[2:]
    names = argv or sorted(ORACLE)
    spark = local_session(8)
    if tz:
        spark.conf.set("spark.sql.session.timeZone", tz)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "error": repr(e)[:400]}
        bad += not r["ok"]
        print(("OK  " if r["ok"] else "BAD ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
