"""Compare a Spark result with the SQL oracle, row for row."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for name in (
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
        "embeddings", "pages", "benchmark", "labels", "conversations",
    ):
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, Decimal):
        return v.normalize()
    return v


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_cell(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect())


def sql_rows(con, text: str) -> tuple[list[str], Counter]:
    cursor = con.execute(text)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(_cell(r[i]) for i in order) for r in cursor.fetchall())
    return sorted(names), rows


def type_kinds(df) -> dict[str, str]:
    kind = {"bigint": "int", "int": "int", "smallint": "int", "tinyint": "int"}
    return {f.name: kind.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
