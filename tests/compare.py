"""Order-insensitive, exact comparison of a Spark result and a DuckDB result."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _bag(rows) -> Counter:
    return Counter(
        tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in row) for row in rows
    )


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Nothing where names, types and all values agree; what differs otherwise."""
    result = con.sql(sql)
    expected_types = dict(zip(result.columns, map(str, result.types), strict=True))
    got_types = {name: TYPES.get(type_, type_) for name, type_ in df.dtypes}
    if got_types != expected_types:
        return [f"types: {got_types} instead of {expected_types}"]
    columns = sorted(got_types)
    got = _bag(tuple(row) for row in df.select(*columns).collect())
    expected = _bag(result.select(*(f'"{c}"' for c in columns)).fetchall())
    if got == expected:
        return []
    extra, missing = list((got - expected).items())[:3], list((expected - got).items())[:3]
    return [f"{sum(got.values())} rows instead of {sum(expected.values())}", f"extra: {extra}", f"missing: {missing}"]
