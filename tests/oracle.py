"""Compare a registered query with its DuckDB text on the same Parquet files.

    python -m tests.oracle [--sf sf0.01] [name-prefix ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

DATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if hasattr(v, "toArray"):
        return tuple(_plain(x) for x in v.toArray())
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def _key(row):
    return tuple((v is None, str(type(v).__name__), v if isinstance(v, (int, float)) else str(v)) for v in row)


def _norm(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(([_plain(r[i]) for i in order] for r in rows), key=_key)


DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
              "TIMESTAMP": "timestamp_ntz", "DATE": "date", "BOOLEAN": "boolean", "FLOAT": "float",
              "SMALLINT": "smallint", "TINYINT": "tinyint"}


def compare(spark, con, name, query, sql, folder):
    """Empty string when both sides agree, otherwise what differs."""
    df = query(spark, folder)
    got_cols, got = _norm(df.columns, df.collect())
    if sql is None:
        return "" if got else "no rows"
    rel = con.execute(sql)
    described = rel.description
    want_cols, want = _norm([d[0] for d in described], rel.fetchall())
    if got_cols != want_cols:
        return f"columns {sorted(set(got_cols) ^ set(want_cols))}"
    want_types = {r[0]: DUCK_TYPES.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    got_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    bad = {c: (got_types[c], want_types[c]) for c in got_cols if got_types[c] != want_types[c]}
    if bad:
        return f"types (spark, duckdb) {bad}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    diff = [(g, w) for g, w in zip(got, want) if g != w]
    if diff:
        g, w = diff[0]
        cells = [(c, a, b) for c, a, b in zip(got_cols, g, w) if a != b]
        return f"{len(diff)}/{len(got)} rows differ, first: {cells[:6]} in {list(zip(got_cols, g))[:4]}"
    return ""


def main(argv):
    from cardloom.session import build_session
    import __spark_entry__ as entry
    sf, names = "sf0.01", []
    it = iter(argv)
    for a in it:
        if a == "--sf":
            sf = next(it)
        else:
            names.append(a)
    folder = f"{DATA}/{sf}"
    spark, con = build_session("oracle"), duck(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, q in queries.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            msg = compare(spark, con, name, q, oracles.get(name), folder)
        except Exception as e:  # report and go on
            msg = f"{type(e).__name__}: {str(e)[:600]}"
        failed += bool(msg)
        kind = "sql" if name in oracles else "rows"
        print(f"{'FAIL' if msg else 'ok  '} {name} [{kind}] {time.time() - start:.1f}s {msg}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
