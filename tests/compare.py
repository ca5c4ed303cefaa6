"""Compares a Spark frame with DuckDB's answer, value by value."""

import datetime
import decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


_FAMILY = {"int": "integer", "bigint": "bigint", "double": "double", "string": "varchar",
           "date": "date", "timestamp": "timestamp", "timestamp_ntz": "timestamp"}


def assert_same(frame, connection, sql):
    answer = connection.execute(sql)
    names = [d[0] for d in answer.description]
    expected = answer.fetchall()
    assert sorted(frame.columns) == sorted(names)
    kinds = dict(zip(names, [str(d[1]).lower() for d in answer.description]))
    for field in frame.schema:
        mine = field.dataType.simpleString()
        mine = _FAMILY.get(mine, mine)
        assert mine == kinds[field.name], (field.name, mine, kinds[field.name])
    actual = frame.collect()
    assert len(actual) == len(expected)
    mine, theirs = _rows(frame.columns, actual), _rows(names, expected)
    for a, b in zip(mine, theirs):
        assert a == b
