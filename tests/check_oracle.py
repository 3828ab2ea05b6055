"""Compare every query with its SQL: ``python tests/check_oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def normal(frame):
    """Columns by name, values as plain text-comparable rows, sorted."""
    frame = frame[sorted(frame.columns)]
    rows = [
        tuple(None if v is None or v != v else (float(v) if isinstance(v, float) else v) for v in row)
        for row in frame.itertuples(index=False)
    ]
    return list(frame.columns), sorted(rows, key=repr)


def compare(df, con, name: str) -> str:
    """Empty when equal, else the difference."""
    ours = normal(df.toArrow().to_pandas().astype(object))
    theirs = normal(con.sql(oracle_sql()[name]).to_arrow_table().to_pandas().astype(object))
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    if ours[1] != theirs[1]:
        extra = [r for r in ours[1] if r not in theirs[1]][:2]
        lacking = [r for r in theirs[1] if r not in ours[1]][:2]
        return f"{len(ours[1])} rows against {len(theirs[1])}; only ours {extra}; only SQL {lacking}"[:1500]
    return ""


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    con = connect(folder)
    for name in sys.argv[2:] or oracle_sql():
        begun = time.time()
        try:
            verdict = compare(queries()[name](spark, folder), con, name)
        except Exception as error:  # report and go on with the next query
            verdict = f"{type(error).__name__}: {str(error)[:800]}"
        print(f"{name:26s} {time.time() - begun:6.2f}s  {verdict or 'equal'}", flush=True)
