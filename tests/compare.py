"""Order-free comparison of a Spark result with the SQL result on the same tables."""

from __future__ import annotations

import datetime
import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, datetime.datetime):
        return v.date().isoformat() if v.time() == datetime.time() else v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return str(v)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
}


def differences(df, con, sql):
    """A list of what differs; empty when names, types and values agree."""
    con.execute(sql)
    names = [d[0] for d in con.description]
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in con.description}
    want = bag(names, con.fetchall())
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    out = []
    if sorted(names) != sorted(df.columns):
        out.append(f"columns {sorted(df.columns)} / {sorted(names)}")
    types = dict(df.dtypes)
    if types != kinds:
        out.append(f"types { {k: (types.get(k), kinds.get(k)) for k in kinds if types.get(k) != kinds.get(k)} }")
    if got != want:
        out.append(f"only spark {list((got - want).items())[:4]} only sql {list((want - got).items())[:4]}")
    return out
