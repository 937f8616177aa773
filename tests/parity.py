"""Runs a query and its DuckDB twin over the same tables."""

from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(df):
    columns = sorted(df.columns)
    return columns, Counter(repr(tuple(r)) for r in df.select(*columns).collect())


def twin_rows(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    at = [names.index(c) for c in sorted(names)]
    return sorted(names), Counter(repr(tuple(r[i] for i in at)) for r in found.fetchall())
