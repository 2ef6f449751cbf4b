"""Compare a query with its SQL, row for row, as bags."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, Decimal):
        return float(f"{float(value):.12g}")
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


def oracle(folder: str, sql: str):
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    cursor = connection.execute(sql)
    return [c[0] for c in cursor.description], [str(c[1]) for c in cursor.description], cursor.fetchall()


def difference(df, folder: str, sql: str) -> str | None:
    """None when both give the same columns and rows, else a short account."""
    columns, _, rows = oracle(folder, sql)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    ours, theirs = bag(df.columns, df.collect()), bag(columns, rows)
    if ours == theirs:
        return None
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; "
        f"only ours {list((ours - theirs).items())[:2]}; only theirs {list((theirs - ours).items())[:2]}"
    )
