"""Run registered queries and their SQL side by side and compare the rows."""

from __future__ import annotations

import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, float)):
        return (2, v + 0.0 if isinstance(v, float) else v)
    return (3, str(v))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN"}


def differences(df, con, sql: str) -> list[str]:
    """Empty if the query and its SQL give the same columns, types and rows."""
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    want = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    out = [
        f"type of {n}: {k} != {kinds[n]}" for n, k in df.dtypes if KINDS.get(k, k) != kinds[n]
    ]
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(want):
        out.append(f"{len(got)} rows != {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        out.append(f"{len(bad)} rows differ, first:\n  spark {bad[0][0]}\n  sql   {bad[0][1]}")
    return out
