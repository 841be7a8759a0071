"""Compare a Spark result with SQL over the same tables, as multisets of rows."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def rows_of(df) -> Counter:
    names = sorted(df.columns)
    return Counter(tuple(row[n] for n in names) for row in df.select(*names).collect())


def oracle_rows(sql: str, sf_dir: str) -> tuple[list[str], Counter]:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(row[i] for i in order) for row in result.fetchall())
