"""Runs registered queries beside their SQL: python tests/check_oracle.py [folder] [name ...]"""

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fieldlens.session import build_session  # noqa: E402
from fieldlens.workload import ORACLES, QUERIES  # noqa: E402
from fieldlens.workload.registry import SOURCES  # noqa: E402


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in SOURCES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def normal(frame):
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if pd.api.types.is_bool_dtype(frame[c]) or (frame[c].dropna().map(lambda v: isinstance(v, bool)).all() and len(frame[c].dropna())):
            frame[c] = frame[c].map(lambda v: None if pd.isna(v) else str(bool(v)))
        elif pd.api.types.is_numeric_dtype(frame[c]):
            frame[c] = frame[c].astype(float)
        elif pd.api.types.is_datetime64_any_dtype(frame[c]):
            frame[c] = frame[c].astype("datetime64[us]").astype(str)
        else:
            frame[c] = frame[c].map(lambda v: None if v is None or v is pd.NaT or (isinstance(v, float) and pd.isna(v)) else str(v))
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def differences(spark_frame, sql_frame):
    """Text of the first difference, or None."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} / {len(sql_frame)}"
    a, b = normal(spark_frame), normal(sql_frame)
    for c in a.columns:
        differs = ~((a[c] == b[c]) | (a[c].isna() & b[c].isna()))
        if differs.any():
            i = differs.idxmax()
            return f"column {c}, {int(differs.sum())} rows, first:\n{a.loc[i].to_dict()}\n{b.loc[i].to_dict()}"
    return None


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("local[8]", 8, **{"spark.driver.memory": "8g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = []
    for name in names:
        start = time.time()
        try:
            frame = QUERIES[name](spark, folder)
            got = frame.toPandas()
            took = time.time() - start
            if name in ORACLES:
                start = time.time()
                wrong = differences(got, con.execute(ORACLES[name]).df())
                took_sql = time.time() - start
            else:
                wrong, took_sql = None, float("nan")
        except Exception as error:  # noqa: BLE001
            wrong, took, took_sql, got = f"{type(error).__name__}: {str(error)[:1500]}", time.time() - start, 0, []
        print(f"{'FAIL' if wrong else 'ok  '} {name:28s} rows={len(got):7d} spark={took:6.2f}s sql={took_sql:5.2f}s"
              f"{'' if name in ORACLES else ' (rows only)'}", flush=True)
        if wrong:
            bad.append(name)
            print("     ", wrong, flush=True)
        elif len(got) == 0:
            print("      EMPTY")
    print(f"{len(names) - len(bad)} of {len(names)} agree; failing: {bad}")


if __name__ == "__main__":
    main()
