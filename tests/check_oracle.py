"""Compare every registered query with its SQL counterpart: names, row counts, values, order-insensitive.

    python tests/check_oracle.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        kind = df[c].dtype
        if pd.api.types.is_datetime64_any_dtype(kind):
            df[c] = df[c].astype("datetime64[us]").astype(str)
        elif pd.api.types.is_numeric_dtype(kind):
            df[c] = df[c].astype("float64").map(lambda v: "" if np.isnan(v) else repr(v))
        else:
            df[c] = df[c].map(lambda v: "" if v is None or v is pd.NaT or v != v else str(v).removesuffix(" 00:00:00"))
    return df.sort_values(list(df.columns), kind="stable").reset_index(drop=True)


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def type_differences(spark_df, sql: str, con) -> list[str]:
    want = {row[0]: row[1] for row in con.execute(f"describe {sql}").fetchall()}
    return [f"{c}: {kind} != {want.get(c)}" for c, kind in spark_df.dtypes if TYPES.get(kind) != want.get(c)]


def differences(spark_df, sql: str, con) -> tuple[str | None, int]:
    types = type_differences(spark_df, sql, con)
    if types:
        return f"types {types}", -1
    got = canonical(spark_df.toPandas())
    want = canonical(con.execute(sql).df())
    if list(got.columns) != list(want.columns):
        return f"columns {list(got.columns)} != {list(want.columns)}", len(got)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", len(got)
    wrong = (got != want).any(axis=1)
    if wrong.any():
        i = wrong.idxmax()
        bad = [c for c in got.columns if got.at[i, c] != want.at[i, c]]
        return f"{wrong.sum()} rows differ, e.g. {bad}: {got.loc[i, bad].tolist()} != {want.loc[i, bad].tolist()}", len(got)
    return None, len(got)


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    statements, failed = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names or name not in statements:
            continue
        begun = time.time()
        try:
            problem, n = differences(query(spark, sf_dir), statements[name], con)
        except Exception as e:  # report and go on with the next query
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {name:28} {n:8} {time.time() - begun:6.2f}s {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
