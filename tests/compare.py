"""Run every query beside its SQL in DuckDB and compare columns and rows."""

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def open_duckdb(sf_dir: str):
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def compare(spark, con, sf_dir: str, name: str, function, sql: str | None) -> str:
    """Empty if both agree, else what differs."""
    df = function(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return ""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    if got != want:
        return (f"{sum(got.values())} rows instead of {sum(want.values())}; only here "
                f"{list((got - want).items())[:3]}, only in SQL {list((want - got).items())[:3]}")
    return "" if got else "no rows"


if __name__ == "__main__":
    from conftest import make_session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(entry.queries())
    session, con, bad = make_session(), open_duckdb(sf_dir), 0
    for key in chosen:
        began = time.time()
        try:
            problem = compare(session, con, sf_dir, key, entry.queries()[key], entry.oracle_sql().get(key))
        except Exception as exc:
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += bool(problem)
        print(f"{'BAD' if problem else 'ok ':4} {key} {time.time() - began:.2f}s {problem}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")
