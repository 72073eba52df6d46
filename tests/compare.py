"""Runs registered queries beside their DuckDB SQL: `python tests/compare.py <folder> [query ...]`."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
import pandas as pd

from tidemark.catalog import oracles
from tidemark.catalog.queries import QUERIES


SECONDS: dict[str, float] = {}     # DuckDB's share


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value))
    return str(value)


def as_rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def differences(spark, con, folder: str, name: str) -> list[str]:
    df = QUERIES[name](spark, folder)
    ours = as_rows(df.columns, [tuple(r) for r in df.collect()])
    begun = time.time()
    result = con.execute(oracles.statement(name))
    theirs = as_rows([d[0] for d in result.description], result.fetchall())
    SECONDS[name] = time.time() - begun
    if ours[0] != theirs[0]:
        return [f"columns {set(ours[0]) ^ set(theirs[0])}"]
    out = []
    if len(ours[1]) != len(theirs[1]):
        out.append(f"rows {len(ours[1])} vs {len(theirs[1])}")
    ours_only, theirs_only = pd.Series(ours[1]).value_counts(), pd.Series(theirs[1]).value_counts()
    gap = ours_only.sub(theirs_only, fill_value=0)
    gap = gap[gap != 0]
    if len(gap):
        out.append(f"{len(gap)} differing rows of {len(ours[1])}")
        for rows, side in ((gap[gap > 0], "spark "), (gap[gap < 0], "duckdb")):
            out += [f"  {side} {dict(zip(ours[0], r))}" for r in sorted(rows.index)[:2]]
    return out


def main() -> None:
    from tidemark.session import get_spark
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = get_spark(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
                      spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in names:
        start = time.time()
        try:
            found = differences(spark, con, folder, name)
        except Exception as e:  # noqa: BLE001
            found = [f"{type(e).__name__}: {str(e)[:700]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s (duckdb {SECONDS.get(name, 0):.1f}s)", *found, sep="\n  ", flush=True)
    print(f"{len(names) - bad} of {len(names)} match")


if __name__ == "__main__":
    main()
