"""Run queries and their SQL side by side and compare rows, columns and values."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(value):
    if isinstance(value, float):
        return ("f", "nan" if math.isnan(value) else repr(value + 0.0))
    return (type(value).__name__, str(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_key(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir, query, sql) -> str | None:
    """None if equal, otherwise what differs."""
    df = query(spark, sf_dir)
    spark_rows = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    sql_rows = cursor.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    left, right = _rows(df.columns, spark_rows), _rows(columns, sql_rows)
    if left == right:
        return None
    return (
        f"rows {len(spark_rows)} vs {len(sql_rows)}; only spark {sum((left - right).values())}: "
        f"{list((left - right))[:2]}; only sql: {list((right - left))[:2]}"
    )


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tidemark.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark, con, oracle = local_session("8", "compare"), connect(sf_dir), oracle_sql()
    for name, query in queries().items():
        if (only and name not in only) or name not in oracle:
            continue
        start = time.time()
        try:
            outcome = compare(spark, con, sf_dir, query, oracle[name])
        except Exception as error:  # report and go on with the next query
            outcome = f"{type(error).__name__}: {str(error)[:400]}"
        print(f"{'ok  ' if outcome is None else 'DIFF'} {name} {time.time() - start:.2f}s {outcome or ''}", flush=True)


if __name__ == "__main__":
    main()
