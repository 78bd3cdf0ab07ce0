"""Side-by-side run of a registered query and its SQL twin."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if v is None:
        return "\0null"
    if isinstance(v, float):
        if math.isnan(v):
            return "\0nan"
        return repr(v + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in data)


def compare(spark, con, fn, sql, sf_dir):
    """None if equal, else a text saying where they differ."""
    df = fn(spark, sf_dir)
    got = rows(df.columns, df.collect())
    if sql is None:
        return None if len(got) else "no rows"
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = rows(names, res.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if got == want:
        kinds = {f.name: f.dataType.simpleString() for f in df.schema}
        other = {d[0]: str(d[1]) for d in res.description}
        for n, k in kinds.items():
            pair = (k, other[n].upper())
            ok = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                  "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "float": "FLOAT"}
            if k in ok and ok[k] != pair[1]:
                return f"type of {n}: {pair}"
        return None if got else "both empty"
    diff = [(g, w) for g, w in zip(got, want) if g != w][:3]
    only_g = sorted(set(got) - set(want))[:3]
    only_w = sorted(set(want) - set(got))[:3]
    return f"rows {len(got)} vs {len(want)}; first {diff[:1]}; only spark {only_g}; only sql {only_w}"
