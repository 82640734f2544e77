"""Compares a query with its DuckDB SQL over the driver tables."""

from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    return repr(v) if isinstance(v, float) else str(v)


def same_rows(spark, sf, query, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = query(spark, sf)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    want = Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall())
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])
