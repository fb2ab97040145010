"""Compares a query's rows with its SQL on the same tables."""
import glob
import math
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        source = path if os.path.isfile(path) else f"{path}/*.parquet"
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{source}'")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float):
        return float(f"{value:.6g}")
    if hasattr(value, "isoformat"):
        return value.isoformat().replace("T00:00:00", "")[:26]
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def assert_equal(spark_df, con, sql):
    names = spark_df.columns
    got = rows_of(names, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    other = [c[0] for c in result.description]
    assert sorted(names) == sorted(other)
    assert got == rows_of(other, result.fetchall())
