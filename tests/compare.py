"""Exact comparison of a Spark result with DuckDB's answer to the matching SQL."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value if value is None else str(value)


def _bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, Counter(tuple(_cell(row[i]) for i in order) for row in rows)


KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def differences(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """A description of the first difference, or None."""
    expected = con.execute(sql)
    exp_types = {d[0]: str(d[1]) for d in expected.description}
    exp_names, exp_bag = _bag([d[0] for d in expected.description], expected.fetchall())
    got_names, got_bag = _bag(result.columns, result.collect())
    if got_names != exp_names:
        return f"columns differ: spark {got_names}, sql {exp_names}"
    for name, spark_type in result.dtypes:
        if KINDS.get(spark_type) != exp_types[name]:
            return f"type of {name} differs: spark {spark_type}, sql {exp_types[name]}"
    if got_bag != exp_bag:
        only_spark, only_sql = got_bag - exp_bag, exp_bag - got_bag
        return (
            f"{sum(got_bag.values())} against {sum(exp_bag.values())} rows; "
            f"only spark {list(only_spark)[:2]}; only sql {list(only_sql)[:2]}"
        )
    if not got_bag:
        return "both sides are empty"
    return None
