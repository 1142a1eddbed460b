"""Comparison of a Spark result with the check engine's."""

from __future__ import annotations

import math

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "date": "DATE"}


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(v) -> tuple[int, str]:
    if v is None:
        return (0, "")
    if isinstance(v, float) and math.isnan(v):
        return (1, "nan")
    return (1, repr(v))


def canonical(cols, rows) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def differences(con, sql: str, df, rows) -> list[str]:
    """What differs between a Spark result and the check SQL: columns, types, values."""
    rel = con.sql(sql)
    cols, types, want = rel.columns, [str(t) for t in rel.types], rel.fetchall()
    if sorted(df.columns) != sorted(cols):
        return [f"columns {sorted(df.columns)} vs {sorted(cols)}"]
    have = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    out = [f"type of {c}: {have[c]} vs {t}" for c, t in zip(cols, types, strict=True) if have[c] != t]
    got, exp = canonical(df.columns, rows), canonical(cols, want)
    if got != exp:
        out.append(f"{len(got)} vs {len(exp)} rows")
        pairs = [(g, e) for g, e in zip(got, exp) if g != e][:2]
        out += [f"got {[x[1] for x in g]}\n    exp {[x[1] for x in e]}" for g, e in pairs]
    return out
