"""Run registered queries beside their SQL: python tools/compare.py [sf] [name ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from chunkgate.catalog import registry  # noqa: E402
from chunkgate.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def open_tables(sf_dir: str):
    db = duckdb.connect()
    db.execute("SET TimeZone='UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows in a fixed order."""
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        column = frame[c]
        if str(column.dtype).startswith("datetime"):
            frame[c] = column.astype("datetime64[us]").astype(str)
        elif column.dtype.kind == "f":
            frame[c] = column.map(lambda v: "null" if pd.isna(v) else repr(float(v) + 0.0))
        else:
            frame[c] = column.map(lambda v: "null" if v is None or v is pd.NaT or v is pd.NA or v != v else str(v))
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def differences(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} / {sorted(sql_rows.columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} / {len(sql_rows)}"
    for c in spark_rows.columns:
        kinds = spark_rows[c].dtype.kind, sql_rows[c].dtype.kind
        if kinds[0] != kinds[1] and not set(kinds) <= {"M", "O"}:
            a, b = spark_rows[c], sql_rows[c]
            if not (a.isna().any() or b.isna().any()):
                return f"type of {c}: {a.dtype} / {b.dtype}"
    left, right = normal(spark_rows), normal(sql_rows)
    unequal = left.ne(right).any(axis=1)
    if unequal.any():
        first = unequal.idxmax()
        return f"{int(unequal.sum())} rows, e.g. {str(left.loc[first].to_dict())[:300]} / {str(right.loc[first].to_dict())[:300]}"
    return None


def main() -> None:
    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    queries, sqls = registry.queries(), registry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark = local_session(8)
    db = open_tables(sf_dir)
    for name in names:
        start = time.time()
        try:
            got = queries[name](spark, sf_dir).toPandas()
        except Exception as error:  # report and go on with the next query
            print(f"{name:24} ERROR {str(error)[:600]}", flush=True)
            continue
        took = time.time() - start
        if name not in sqls:
            print(f"{name:24} rows only {len(got):8} {took:6.2f}s", flush=True)
            continue
        start = time.time()
        try:
            want = db.execute(sqls[name]).df()
        except Exception as error:
            print(f"{name:24} SQL ERROR {str(error)[:600]}", flush=True)
            continue
        verdict = differences(got, want)
        print(f"{name:24} {'ok' if verdict is None else 'DIFF ' + verdict} {len(got):8} {took:6.2f}s sql {time.time() - start:5.2f}s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
