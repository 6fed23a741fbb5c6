"""Compare a query's rows with those of its SQL twin, the way the driver does: columns by name, rows in any order."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def run_sql(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return repr(v)


def compare(df, sql: str, sf_dir: str) -> str | None:
    """None if equal, otherwise what differs."""
    names, want = run_sql(sql, sf_dir)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    got = [tuple(_plain(r[c]) for c in order) for r in df.collect()]
    at = [names.index(c) for c in order]
    wanted = [tuple(_plain(r[i]) for i in at) for r in want]
    if Counter(got) != Counter(wanted):
        more, less = Counter(got) - Counter(wanted), Counter(wanted) - Counter(got)
        return f"{order}: {len(got)} rows / {len(wanted)} wanted; only got {list(more)[:3]}; only wanted {list(less)[:3]}"
    return None
