"""Run registered queries beside their SQL twins and report differences.

    python tools/check_queries.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import bindings  # noqa: E402
from marquetry.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

KINDS = {
    "int": "int", "bigint": "bigint", "double": "double", "string": "varchar", "boolean": "boolean",
    "date": "date",
}


def duck(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def compare(spark, con, name: str, sf: str) -> str:
    """'ok' or what differs, comparing columns by name and rows in any order."""
    df = bindings.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = [tuple(r[c] for c in columns) for r in df.select(*columns).collect()]
    if name not in bindings.SQL:
        return f"ok (rows only: {len(got)})"
    rel = con.sql(bindings.SQL[name])
    if sorted(rel.columns) != columns:
        return f"columns {columns} != {sorted(rel.columns)}"
    types = {c: str(t).lower().replace("integer", "int") for c, t in zip(rel.columns, rel.types)}
    ours = {c: KINDS.get(t, t) for c, t in df.dtypes}
    odd = {c: (ours[c], types[c]) for c in columns if ours[c] != types[c]}
    order = [rel.columns.index(c) for c in columns]
    want = [tuple(r[i] for i in order) for r in rel.fetchall()]
    key = repr
    got, want = sorted(got, key=key), sorted(want, key=key)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}"
    return f"types {odd}" if odd else f"ok ({len(got)} rows)"


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(bindings.QUERIES)
    spark = local_session(8)
    con = duck(sf)
    failed = []
    for name in names:
        start = time.perf_counter()
        try:
            result = compare(spark, con, name, sf)
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:600]}"
        if not result.startswith("ok"):
            failed.append(name)
        print(f"{time.perf_counter() - start:6.2f}s {name}: {result}", flush=True)
    print(f"{len(names) - len(failed)} of {len(names)} ok; failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
