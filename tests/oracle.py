"""Comparison of a query with its SQL on the same tables."""

import datetime
import decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, bool):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        return "nan" if v != v else round(float(v), 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def check(spark, sf_dir, query, sql):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=str)
    out = db.execute(sql)
    order = [d[0] for d in out.description]
    assert sorted(order) == names
    want = sorted((tuple(plain(r[order.index(n)]) for n in names) for r in out.fetchall()), key=str)
    assert got == want
