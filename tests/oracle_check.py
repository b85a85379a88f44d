"""Compare a registered query with its SQL counterpart: names, kinds of types, rows."""

from __future__ import annotations

import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE"}


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _key(row):
    return tuple((v is None, f"{v:.4f}" if isinstance(v, float) else str(v)) for v in row)


def difference(df, con, sql: str) -> str | None:
    """None when both sides agree, else what differs first."""
    rel = con.sql(sql)
    theirs = dict(zip(rel.columns, [str(t) for t in rel.types]))
    ours = {n: KINDS.get(t, t) for n, t in df.dtypes}
    if ours != theirs:
        return f"schema: {ours} != {theirs}"
    names = sorted(ours)
    left = sorted((tuple(r[n] for n in names) for r in df.collect()), key=_key)
    order = [rel.columns.index(n) for n in names]
    right = sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=_key)
    if len(left) != len(right):
        return f"rows: {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        for x, y in zip(a, b):
            same = math.isclose(x, y, abs_tol=1e-9) if isinstance(x, float) and isinstance(y, float) else x == y
            if not same:
                return f"row: {a} != {b}"
    return None
