"""Runs a registered query on Spark and its statement on DuckDB and compares columns, types and rows."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value: object) -> object:
    if isinstance(value, Decimal):
        return ("dec", value.normalize())
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


_TYPES = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean", "DATE": "date",
    "TIMESTAMP": "timestamp",
}


def _type(name: str) -> str:
    return _TYPES.get(name, name.lower().replace(" ", ""))


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    relation = con.sql(sql)
    wanted = dict(zip(relation.columns, (_type(str(t)) for t in relation.types)))
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    problems = []
    if sorted(wanted) != sorted(found):
        return [f"columns differ: spark {sorted(found)} duckdb {sorted(wanted)}"]
    problems += [f"type of {c}: spark {found[c]} duckdb {wanted[c]}" for c in sorted(found) if found[c] != wanted[c]]
    names = sorted(found)
    left = Counter(tuple(_plain(row[c]) for c in names) for row in df.collect())
    order = [relation.columns.index(c) for c in names]
    right = Counter(tuple(_plain(row[i]) for i in order) for row in relation.fetchall())
    if left != right:
        problems.append(
            f"rows differ: spark {sum(left.values())} duckdb {sum(right.values())}; only spark "
            f"{list((left - right).items())[:2]}; only duckdb {list((right - left).items())[:2]}"
        )
    if not left:
        problems.append("no rows")
    return problems
