"""Compare a query with its SQL in DuckDB: same columns, same rows, floats to nine digits."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    return float(f"{v:.9g}") if isinstance(v, float) else tuple(map(norm, v)) if isinstance(v, (list, tuple)) else v


def compare(df, sql, sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = c.sql(sql)
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    got = sorted((tuple(map(norm, r)) for r in df.select(*cols).collect()), key=repr)
    assert got == sorted((tuple(map(norm, r)) for r in want.select(*[f'"{x}"' for x in cols]).fetchall()), key=repr)
