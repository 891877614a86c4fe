"""Compare queries with their SQL: python tests/check.py [sf] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TESTDATA = "/root/testdata"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def canonical(pdf: pd.DataFrame) -> list[str]:
    ordered = pdf[sorted(pdf.columns)]
    rows = []
    for row in ordered.itertuples(index=False):
        cells = []
        for v in row:
            if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and pd.isna(v)):
                cells.append("∅")
            elif isinstance(v, bool) or type(v).__name__ == "bool_":
                cells.append(str(bool(v)))
            elif isinstance(v, float):
                cells.append(repr(float(v) + 0.0))
            elif hasattr(v, "item"):
                v = v.item()
                cells.append(repr(v + 0.0) if isinstance(v, (int, float)) else str(v))
            elif isinstance(v, int):
                cells.append(repr(v + 0.0))
            else:
                cells.append(str(v))
        rows.append("|".join(cells))
    return sorted(rows)


def difference(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None if both give the same columns and rows."""
    got, want = query(spark, sf_dir).toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        return f"{len(a)} vs {len(b)} rows; spark only {only_a}; sql only {only_b}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from ebbtide.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    sf_dir = f"{TESTDATA}/sf{sf}"
    spark, con = local_session(8), connect(sf_dir)
    oracles, bad = oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = difference(spark, con, sf_dir, query, oracles[name])
            else:
                pdf = query(spark, sf_dir).toPandas()
                problem = None
                print(pdf.to_string(max_rows=12))
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("failures:", bad, "missing oracles:", sorted(set(queries()) - set(oracles)))


if __name__ == "__main__":
    main()
