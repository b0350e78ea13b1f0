"""Side-by-side check of a catalogue query against its SQL oracle (DuckDB).

Mirrors the driver's gate: same column names, same Arrow types, same multiset of rows
(order-insensitive). Used by the tests and by ``python -m vialflow.plans.compare``.
"""

from __future__ import annotations

import datetime as dt
import math
import sys

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(root: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, list):
        return tuple(_norm(x) for x in v)
    return v


def _rows(table):
    names = sorted(table.column_names)
    cols = [table.column(n).to_pylist() for n in names]
    rows = [tuple(_norm(c[i]) for c in cols) for i in range(table.num_rows)]
    return names, sorted(rows, key=repr)


def _types(table):
    return {f.name: str(f.type) for f in table.schema}


def compare(spark, name: str, root: str, con=None) -> dict:
    from .registry import all_queries
    from .oracle import SQL
    CATALOG = all_queries()
    con = con or duck(root)
    got = CATALOG[name](spark, root).toArrow()
    want = con.sql(SQL[name]).to_arrow_table()
    g_names, g_rows = _rows(got)
    w_names, w_rows = _rows(want)
    out = {"name": name, "rows": (len(g_rows), len(w_rows)), "names_ok": g_names == w_names,
           "types_ok": _types(got) == _types(want), "values_ok": g_rows == w_rows}
    out["ok"] = out["names_ok"] and out["types_ok"] and out["values_ok"]
    if not out["types_ok"]:
        out["types"] = (_types(got), _types(want))
    if not out["values_ok"] and out["names_ok"]:
        g_set, w_set = set(g_rows), set(w_rows)
        diff_g = [r for r in g_rows if r not in w_set][:3]
        diff_w = [r for r in w_rows if r not in g_set][:3]
        out["diff"] = (diff_g, diff_w)
    if not out["names_ok"]:
        out["names"] = (g_names, w_names)
    return out


def main(argv: list[str]) -> int:
    from ..session import get_session
    from ..plans.oracle import SQL
    root = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(SQL)
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(root)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, root, con)
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "error": repr(e)[:500]}
        bad += not r["ok"]
        print(("OK  " if r["ok"] else "BAD ") + str(r if not r["ok"] else (n, r["rows"])), flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
