"""Runs a query and its SQL on the same tables and compares them as sets of rows."""

import glob
import math
import os

import duckdb


def run_sql(sql, sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    kinds = dict(zip(names, (str(column[1]) for column in result.description)))
    return names, kinds, result.fetchall()


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    return repr(value)


def normal_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)
