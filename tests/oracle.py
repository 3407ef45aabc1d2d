"""Compare queries with their SQL in DuckDB on the same tables.

    python tests/oracle.py <sf_dir> [query ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cooked = [tuple(normal(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(cooked, key=repr)


def duck(sf_dir):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def compare(spark, connection, sf_dir, name, query, sql):
    """None if equal, else what differs."""
    df = query(spark, sf_dir)
    names, got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection.execute(sql)
    want_names, want = sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    if names != want_names:
        return f"columns {names} vs {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    different = [(g, w) for g, w in zip(got, want) if g != w]
    if different:
        return f"{len(different)} of {len(got)} rows differ, e.g. {different[0]}"
    kinds = {type(v).__name__ for row in got[:50] for v in row}
    want_kinds = {type(v).__name__ for row in want[:50] for v in row}
    return None if kinds == want_kinds else f"types {kinds} vs {want_kinds}"


def main():
    import __spark_entry__ as entry
    from sluice.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("oracle", "local[8]", 8)
    spark.sparkContext.setLogLevel("OFF")
    connection = duck(sf_dir)
    bad = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        begin = time.time()
        sql = entry.oracle_sql().get(name)
        try:
            problem = compare(spark, connection, sf_dir, name, query, sql) if sql else f"no SQL, {query(spark, sf_dir).count()} rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None and not problem.startswith("no SQL")
        print(f"{'ok  ' if problem is None else 'DIFF'} {time.time() - begin:6.2f}s {name} {problem or ''}", flush=True)
    print("different:", bad)


if __name__ == "__main__":
    main()
