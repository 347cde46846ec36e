"""Runs queries and their SQL on the same files and compares the rows.

``python -m bindings.compare [folder] [name ...]`` prints one line per query that differs.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value.isoformat() if isinstance(value, dt.date) else value


def table(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


SAME_TYPES = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
    "date": {"DATE"},
    "timestamp": {"TIMESTAMP", "TIMESTAMP WITH TIME ZONE"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def compare(spark, connection, folder: str, build, sql: str) -> str | None:
    """What differs, or None."""
    df = build(spark, folder)
    mine = table(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    kinds = {d[0]: str(d[1]) for d in result.description}
    theirs = table([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} != {len(theirs[1])}"
    for a, b in zip(mine[1], theirs[1], strict=True):
        if a != b:
            return f"{dict(zip(mine[0], a, strict=True))} != {dict(zip(mine[0], b, strict=True))}"
    odd = {
        c: (k, kinds[c]) for c, k in df.dtypes if k in SAME_TYPES and kinds[c] not in SAME_TYPES[k]
    }
    return f"types {odd}" if odd else None


def main(argv: list[str]) -> int:
    from bindings import ORACLE, QUERIES
    from veritally.session import build_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, bad = connect(folder), 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLE:
                found = compare(spark, connection, folder, QUERIES[name], ORACLE[name])
            else:
                found = None if QUERIES[name](spark, folder).count() >= 0 else "no rows"
        except Exception as error:  # noqa: BLE001 - reported per query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        took = time.time() - start
        if found or took > 8:
            bad += bool(found)
            print(f"{name} [{took:.1f}s]: {found}", flush=True)
    print(f"{len(names)} queries, {len(set(names) & set(ORACLE))} with SQL, {bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
