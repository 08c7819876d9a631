"""Compare all queries with their SQL form: ``python tests/compare.py SF_DIR [name part ...]``."""

from __future__ import annotations

import decimal
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if v != v else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, pd.Timestamp):
        return str(v)
    if hasattr(v, "tolist"):
        return repr(v.tolist())
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    data = [tuple(_plain(v) for v in row) for row in pdf[cols].astype(object).itertuples(index=False)]
    return sorted(data, key=repr)


def difference(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str | None:
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(sql_df.columns)}"
    if len(spark_df) != len(sql_df):
        return f"rows {len(spark_df)} != {len(sql_df)}"
    left, right = rows_of(spark_df), rows_of(sql_df)
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        return f"{len(bad)} of {len(left)} rows differ, first: {bad[0]}"
    kinds = {
        c: (str(spark_df[c].dtype), str(sql_df[c].dtype))
        for c in spark_df.columns
        if str(spark_df[c].dtype) != str(sql_df[c].dtype)
    }
    return f"note: types {kinds}" if kinds else None


def main() -> None:
    import __spark_entry__
    from landgauge.session import local_session

    sf_dir, parts = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if parts and not any(name.startswith(p) for p in parts):
            continue
        start = time.time()
        try:
            got = fn(spark, sf_dir).toPandas()
            took = time.time() - start
            if name not in oracles:
                print(f"rows {name:32} {took:6.1f}s {len(got)} rows {list(got.columns)}", flush=True)
                continue
            want = connect(sf_dir).sql(oracles[name]).df()
            problem = difference(got, want)
        except Exception as e:  # report and go on with the next query
            problem, took, got = f"{type(e).__name__}: {str(e)[:1500]}", time.time() - start, []
        bad = problem is not None and not problem.startswith("note")
        failed += bad
        print(f"{'FAIL' if bad else 'ok  '} {name:32} {took:6.1f}s {len(got)} rows {problem or ''}", flush=True)
        spark.catalog.clearCache()
    print("failed:", failed)


if __name__ == "__main__":
    main()
