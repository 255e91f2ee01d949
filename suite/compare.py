"""Run registered queries and compare them with their SQL in DuckDB.

``python -m suite.compare [sf_dir] [name ...]``
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from suite import all_checks, all_queries
from suite.inputs import TABLES


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(table, key=lambda r: tuple((v is None, str(v)) for v in r))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def compare(spark, con, name: str, sf_dir: str) -> str:
    """'' where rows, names, types and values agree, else what differs."""
    df = all_queries()[name](spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = all_checks().get(name)
    if sql is None:
        return "" if got else "no rows"
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    want_cols, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    kinds = {c: _KINDS.get(t, t) for c, t in df.dtypes}
    odd = {c: (kinds[c], types[c]) for c in kinds if kinds[c] != types[c]}
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for mine, other in zip(got, want, strict=True):
        if mine != other:
            return f"values {mine} != {other}"
    return f"types {odd}" if odd else ("no rows" if not got else "")


def main(args: list[str]) -> int:
    from rollbook.session import local_session

    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(all_queries())
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        state = "FAIL" if problem else ("ok" if name in all_checks() else "rows")
        print(f"{state:5}{name:28}{time.time() - start:7.2f}s {problem}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
