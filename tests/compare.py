"""Run queries against their SQL: ``python tests/compare.py [folder] [name ...]``."""

import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="feedback_loom-tests-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def ordered(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    keys = frame.map(repr)
    return frame.loc[keys.sort_values(list(keys.columns)).index].reset_index(drop=True)


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted(map(tuple, frame.itertuples(index=False)), key=repr)


def kind_of(column: pd.Series) -> str:
    """The kind of a column's values; unknown if it has none."""
    values = column.dropna()
    if not len(values):
        return "unknown"
    value = values.iloc[0]
    if isinstance(value, (bool, np.bool_)):
        return "boolean"
    if isinstance(value, (int, np.integer)) or (isinstance(value, (float, np.floating)) and column.isna().any()
                                                and all(float(v).is_integer() for v in values)):
        return "integer"
    return {"float": "double", "float64": "double", "float32": "double"}.get(type(value).__name__, type(value).__name__)


def difference(spark_frame: pd.DataFrame, duck_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(duck_frame.columns):
        return f"columns {sorted(spark_frame.columns)} vs {sorted(duck_frame.columns)}"
    kinds = [f"{c}: {kind_of(spark_frame[c])} vs {kind_of(duck_frame[c])}" for c in spark_frame.columns
             if {kind_of(spark_frame[c]), kind_of(duck_frame[c])} - {"unknown"} not in (set(), {kind_of(spark_frame[c])}, {kind_of(duck_frame[c])})]
    if kinds:
        return f"types {kinds}"
    left, right = rows_of(spark_frame), rows_of(duck_frame)
    if len(left) != len(right):
        return f"rows {len(left)} vs {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} of {len(left)} differ, first {str(wrong[0])[:600]}" if wrong else None


def main() -> None:
    import __spark_entry__ as contract

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark, connection = local_session(), duck(folder)
    queries, oracles = contract.queries(), contract.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            got = queries[name](spark, folder).toPandas()
            took = time.time() - start
            problem = None
            if name in oracles:
                problem = difference(got, connection.execute(oracles[name]).df())
            print(f"{'FAIL' if problem else 'ok' if name in oracles else 'rows'} {name} {len(got)} rows {took:.1f}s"
                  f" (sql {time.time() - start - took:.1f}s) {problem or ''}", flush=True)
        except Exception as error:
            problem = str(error)[:1500]
            print(f"ERROR {name} {problem}", flush=True)
        bad += bool(problem)
    print("failed:", bad)


if __name__ == "__main__":
    main()
