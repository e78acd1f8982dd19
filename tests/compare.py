"""Row-by-row comparison of a Spark result with DuckDB's answer on the same files."""

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def sorted_rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(row[i] for i in order) for row in rows)


def assert_same(df, con, sql: str) -> int:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = sorted_rows(names, result.fetchall())
    assert sorted(df.columns) == sorted(names)
    actual = sorted_rows(df.columns, map(tuple, df.collect()))
    missing, extra = expected - actual, actual - expected
    assert not missing and not extra, f"missing {list(missing)[:3]}, extra {list(extra)[:3]}"
    return sum(actual.values())
