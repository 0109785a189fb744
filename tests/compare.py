"""Comparison of a query's rows with those of its SQL."""

import duckdb
import pandas as pd


def views(folder):
    con = duckdb.connect()
    for p in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return None
    if hasattr(v, "tolist"):
        return v.tolist()
    return round(v, 9) if isinstance(v, float) else v


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(repr([float(x) if isinstance(x, int) and not isinstance(x, bool) else x for x in map(plain, r)]) for r in df.itertuples(index=False))


def differing(a, b):
    """Rows that only one side has; the empty list if both have the same columns and rows, each as often."""
    if sorted(a.columns) != sorted(b.columns):
        return [sorted(a.columns), sorted(b.columns)]
    x, y = rows(a), rows(b)
    return [] if x == y else [len(x), len(y), *sorted(set(x) ^ set(y))[:6]]
