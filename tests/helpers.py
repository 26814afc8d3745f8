"""Comparison of a query with its SQL in another engine."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    return repr(v)


def rows_of(columns, rows):
    return sorted("|".join(cell(r[c]) for c in columns) for r in rows)


def same(df, con, sql):
    ours = [r.asDict() for r in df.collect()]
    theirs = con.sql(sql)
    names = theirs.columns
    assert sorted(df.columns) == sorted(names)
    columns = sorted(names)
    want = [dict(zip(names, r, strict=True)) for r in theirs.fetchall()]
    assert rows_of(columns, ours) == rows_of(columns, want)


def entities(spark, rows):
    """rows: (entity_id, name, address, country); seq follows their order."""
    data = [(i, *r, k) for k, (i, *r) in enumerate(rows)]
    return spark.createDataFrame(data, "entity_id string, business_name string, business_address string, country string, seq long")


def have_data():
    return os.path.isdir("/root/testdata/sf0.001")
