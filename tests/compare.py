"""Compares a Spark result with the rows of its checking SQL, as multisets."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else f"{value:.6g}")
    return (1, str(value))


def _same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None:
            return a is b
        return math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=1e-6)
    if hasattr(a, "tzinfo") and hasattr(b, "tzinfo"):
        return a.replace(tzinfo=None) == b.replace(tzinfo=None)
    return a == b


def difference(df, con, sql):
    """None when equal, otherwise a short text."""
    columns = sorted(df.columns)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns: only spark {set(columns) - set(names)}, only sql {set(names) - set(columns)}"
    theirs = [tuple(row[names.index(c)] for c in columns) for row in result.fetchall()]
    ours = [tuple(row[c] for c in columns) for row in df.select(*columns).collect()]
    if len(ours) != len(theirs):
        return f"rows: spark {len(ours)}, sql {len(theirs)}"
    order = lambda row: tuple(_key(v) for v in row if not isinstance(v, float)) + tuple(
        _key(v) for v in row if isinstance(v, float)
    )
    for mine, other in zip(sorted(ours, key=order), sorted(theirs, key=order)):
        bad = [c for c, a, b in zip(columns, mine, other) if not _same(a, b)]
        if bad:
            return f"{bad}: spark {mine} sql {other}"
    return None
