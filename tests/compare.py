"""Compare every registered query with its SQL: ``python -m tests.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    plain = lambda v: None if pd.isna(v) else (v.item() if hasattr(v, "item") else v)
    rows = [tuple(plain(v) for v in row) for row in frame.itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def differences(got: pd.DataFrame, want: pd.DataFrame) -> list[str]:
    """Empty where columns, kinds of types, row counts and all values agree exactly."""
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(got.columns)} / {sorted(want.columns)}"]
    if len(got) != len(want):
        return [f"rows {len(got)} / {len(want)}"]
    problems = []
    for column in got.columns:
        # A column with nulls has no exact pandas type of its own.
        if got[column].notna().all() and got[column].dtype != want[column].dtype:
            problems.append(f"type of {column}: {got[column].dtype} / {want[column].dtype}")
    a, b = _canonical(got), _canonical(want)
    unequal = [(x, y) for x, y in zip(a, b) if x != y]
    if unequal:
        problems.append(f"{len(unequal)} rows differ, first {unequal[0]}")
    return problems


def main() -> int:
    import __spark_entry__ as entry
    from tessera.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    for name in names:
        start = time.time()
        sql = entry.oracle_sql().get(name)
        try:
            got = entry.queries()[name](spark, sf).toPandas()
            spent = time.time() - start
            problems = differences(got, con.execute(sql).df()) if sql else []
        except Exception as error:
            got, spent, problems = [], time.time() - start, [str(error)[:250]]
        bad += bool(problems)
        print(f"{name:28s} {len(got):7d} rows {spent:6.2f}s  "
              f"{'DIFFERS ' + '; '.join(problems) if problems else 'equal' if sql else 'rows only'}", flush=True)
    print(f"{len(names)} queries, {bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
