"""Compare a registered query with its SQL."""

from __future__ import annotations

import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when both results hold the same columns, types and rows."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    theirs = _rows(names, expected.fetchall())
    ours = _rows(df.columns, [tuple(row) for row in df.collect()])
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} / {sorted(names)}")
    kinds = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
             "date": "DATE", "boolean": "BOOLEAN"}
    relation = con.sql(sql)
    sql_types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    for field in df.schema.fields:
        ours_type = kinds.get(field.dataType.simpleString(), field.dataType.simpleString())
        if ours_type != sql_types.get(field.name):
            problems.append(f"type of {field.name}: {ours_type} / {sql_types.get(field.name)}")
    if ours != theirs:
        problems.append(
            f"rows {sum(ours.values())} / {sum(theirs.values())},"
            f" only ours {list((ours - theirs).items())[:3]},"
            f" only theirs {list((theirs - ours).items())[:3]}"
        )
    return problems
