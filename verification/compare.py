"""Run registered queries next to their SQL texts and report which rows agree.

    python -m verification.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from verification.oracles import ORACLES
from verification.queries import QUERIES


def local_session(threads: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{threads}]")
        .appName("clickloom")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def ordered(df: pd.DataFrame) -> pd.DataFrame:
    columns = sorted(df.columns)
    # Whole numbers with nulls come as Int64 from one side and as doubles from the other.
    nullable = {c: "float64" if df[c].hasnans else df[c].dtype.name.lower() for c in columns if df[c].dtype.name in ("Int32", "Int64")}
    return df[columns].astype(nullable).sort_values(columns).reset_index(drop=True)


def differences(ours: pd.DataFrame, theirs: pd.DataFrame) -> str:
    """Empty when the two hold the same columns and the same rows."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} against {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    a, b = ordered(ours), ordered(theirs)
    kinds = [f"{c}: {a[c].dtype} against {b[c].dtype}" for c in a.columns if a[c].dtype.kind != b[c].dtype.kind]
    if kinds:
        return "; ".join(kinds)
    apart = {c: (a[c] != b[c]) & ~(a[c].isna() & b[c].isna()) for c in a.columns}
    wrong = [f"{c}: {int(rows.sum())} rows" for c, rows in apart.items() if rows.any()]
    return "; ".join(wrong)


def main(sf_dir: str, names: list[str]) -> int:
    spark, con = local_session(), tables(sf_dir)
    failures = 0
    for name in names or list(QUERIES):
        started = time.time()
        try:
            ours = QUERIES[name](spark, sf_dir).toPandas()
            seconds = time.time() - started
            verdict = differences(ours, con.execute(ORACLES[name]).df()) if name in ORACLES else None
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            print(f"{name:24s} FAILED {type(error).__name__}: {str(error)[:600]}", flush=True)
            failures += 1
            continue
        failures += bool(verdict)
        note = "rows only" if verdict is None else verdict or "equal"
        print(f"{name:24s} {len(ours):8d} rows {seconds:6.1f} s  {note}", flush=True)
    return failures


if __name__ == "__main__":
    arguments = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(1 if main(arguments[0], arguments[1:]) else 0)
