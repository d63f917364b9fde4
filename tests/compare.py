"""Order-free comparison of a query with its SQL."""

import datetime
import os

import duckdb

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf=SF):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if v != v else f"{v:.9g}"
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items(), key=str)) + "}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(norm, v)) + "]"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def same(df, con, sql):
    columns = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in columns) for r in df.collect())
    found = con.execute(sql)
    names = [x[0] for x in found.description]
    rows = found.fetchall()
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(norm(r[i]) for i in at) for r in rows)
