"""Compare a query with its SQL twin in DuckDB, as bags of rows."""

import math
from pathlib import Path

import duckdb


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(_plain, v))
    return v


def bag(rows):
    return sorted((tuple(map(_plain, r)) for r in rows), key=repr)


def twin(sql, folder):
    con = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    return names, cur.fetchall()


def assert_same(df, sql, folder):
    names, rows = twin(sql, folder)
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    got = [tuple(r[c] for c in order) for r in df.collect()]
    want = [tuple(dict(zip(names, r, strict=True))[c] for c in order) for r in rows]
    assert bag(got) == bag(want)
    return len(got)
