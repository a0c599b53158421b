"""Runs registered queries next to their SQL in DuckDB. Usage: python tests/compare.py FOLDER [query ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz",
    "DATE": "date", "BOOLEAN": "boolean",
}


def engine(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v


def normal(rows) -> list[tuple]:
    return sorted((tuple(cell(v) for v in r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(df, con, sql: str, exact: bool = True) -> str | None:
    """None when names, types, row count and values agree, else what differs."""
    expected = con.sql(sql)
    cols = sorted(df.columns)
    if cols != sorted(expected.columns):
        return f"columns {cols} / {sorted(expected.columns)}"
    ours = {f.name: f.dataType.simpleString() for f in df.schema}
    theirs = {c: KINDS.get(str(k), str(k)) for c, k in zip(expected.columns, expected.types)}
    kinds = [(c, ours[c], theirs[c]) for c in cols if ours[c] != theirs[c]]
    if kinds:
        return f"types {kinds}"
    quoted = ", ".join(f'"{c}"' for c in cols)
    want = normal(con.sql(f"SELECT {quoted} FROM ({sql}) AS q").fetchall())
    got = normal(tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    if len(want) != len(got):
        return f"rows {len(got)} / {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} of {len(want)} rows differ, first (ours, SQL): {wrong[0]}" if wrong else None


def main(folder: str, names: list[str]) -> int:
    from gridlake import session
    from gridlake.queries import QUERIES

    spark = session("compare", "local[8]", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = engine(folder)
    failed = 0
    for name in names or QUERIES:
        q, start = QUERIES[name], time.time()
        try:
            problem = differences(q(spark, folder), con, q.sql) if q.sql else f"no SQL, {q(spark, folder).count()} rows"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed of {len(names or QUERIES)}")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 1))
