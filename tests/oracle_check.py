"""Run a registered query and its SQL and compare them as multisets."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _rows(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return ([columns[i] for i in order],
            Counter(tuple(_plain(row[i]) for i in order) for row in rows))


def _kind(name: str) -> str:
    name = str(name).lower()
    return {"varchar": "string", "integer": "int", "timestamp": "timestamp_ntz"}.get(name, name)


def differences(frame, connection, sql: str) -> list[str]:
    """What differs between a DataFrame and a SQL result; empty when equal."""
    relation = connection.sql(sql)
    ours = _rows(frame.columns, frame.collect())
    theirs = _rows(relation.columns, relation.fetchall())
    if ours[0] != theirs[0]:
        return [f"columns {ours[0]} != {theirs[0]}"]
    types = {f.name: f.dataType.simpleString() for f in frame.schema}
    other = {n: _kind(t) for n, t in zip(relation.columns, relation.types)}
    found = [f"type of {n}: {types[n]} != {other[n]}" for n in types if types[n] != other[n]]
    if ours[1] != theirs[1]:
        found.append(f"rows {sum(ours[1].values())} and {sum(theirs[1].values())}; only ours "
                     f"{list((ours[1] - theirs[1]).items())[:3]}; only theirs "
                     f"{list((theirs[1] - ours[1]).items())[:3]}")
    return found
