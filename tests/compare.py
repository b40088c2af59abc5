"""Row-by-row comparison of a Spark result with the DuckDB result of its oracle SQL."""

import datetime as dt
import decimal
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def canon(v):
    if v is None:
        return ("null", "")
    if isinstance(v, bool):
        return ("bool", str(v))
    if isinstance(v, int):
        return ("num", repr(float(v)))
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        return ("num", "nan" if f != f else repr(round(f, 6) + 0.0))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("date", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("list", str([canon(x) for x in v]))
    return (type(v).__name__, str(v))


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted([tuple(canon(r[i]) for i in order) for r in rows])


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    got_cols, got = table_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = table_of([c[0] for c in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; e.g. {[r for r in got if r not in want][:2]} / {[r for r in want if r not in got][:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]}"
    if not got:
        return "both empty"
    return None
