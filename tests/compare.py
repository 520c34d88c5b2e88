"""Compare a query's rows with those of its SQL in DuckDB."""

import math
from collections import Counter
from pathlib import Path

import duckdb


def connection(sf_dir):
    c = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    return v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return Counter(tuple(plain(r[k]) for k in order) for r in rows)


def difference(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cursor = connection(sf_dir).execute(sql)
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if sorted(df.columns) != sorted(d[0] for d in cursor.description):
        return f"columns {sorted(df.columns)} and {sorted(d[0] for d in cursor.description)}"
    if got == want:
        return ""
    return f"{sum(got.values())} and {sum(want.values())} rows; only here {list((got - want).items())[:2]}, only there {list((want - got).items())[:2]}"
