"""Compare a registered query with its SQL twin on the same Parquet files."""

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

SPARK_TO_SQL = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def compare(df, con, sql):
    """Problems found; empty when names, types and all rows agree."""
    cur = con.execute(sql)
    want_types = {d[0]: str(d[1]) for d in cur.description}
    want_rows = cur.fetchall()
    cols = sorted(df.columns)
    problems = []
    if sorted(want_types) != cols:
        return [f"columns: spark {cols} sql {sorted(want_types)}"]
    for name, typ in df.dtypes:
        want = want_types[name]
        alias = {"STRING": "VARCHAR", "NUMBER": "DOUBLE"}.get(want, want)
        if SPARK_TO_SQL.get(typ, typ) != alias and not alias.startswith("DECIMAL"):
            problems.append(f"type of {name}: spark {typ} sql {want}")
    order = [list(want_types).index(c) for c in cols]
    want = Counter(tuple(_norm(r[i]) for i in order) for r in want_rows)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    if want != got:
        extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
        problems.append(
            f"rows: spark {sum(got.values())} sql {sum(want.values())}\n cols {cols}\n only spark {extra}\n only sql {missing}"
        )
    return problems
