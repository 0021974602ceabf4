"""Runs every registered query against its SQL counterpart: python tests/compare.py SF_DIR [NAME...]"""

import sys
import traceback
from pathlib import Path

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def frames(spark, sf_dir: str, name: str, q, sql: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return q(spark, sf_dir).toPandas(), con.execute(sql).df()


def normal(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    def one(v):
        if v is None or (not isinstance(v, (str, list)) and pd.isna(v)):
            return None
        return f"{float(v):.9g}" if isinstance(v, (int, float)) or type(v).__module__ == "numpy" and hasattr(v, "dtype") and v.dtype.kind in "iuf" else str(v).removesuffix(" 00:00:00")
    return sorted((tuple(one(v) for v in r) for r in df[cols].itertuples(index=False, name=None)), key=str), cols


def same(a: pd.DataFrame, b: pd.DataFrame) -> str:
    (x, cx), (y, cy) = normal(a) if len(a.columns) else ([], []), normal(b)
    if cx != cy:
        return f"columns {cx} {cy}"
    if x != y:
        diff = [(p, q) for p, q in zip(x, y) if p != q][:2]
        return f"rows {len(x)} {len(y)} {diff}"
    return ""


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for n in sys.argv[2:] or [x for x in qs if x in sqls]:
        try:
            why = same(*frames(spark, sys.argv[1], n, qs[n], sqls[n]))
        except Exception as x:
            why = "".join(traceback.format_exception_only(x))[:400]
        if why:
            bad += 1
            print("BAD", n, why[:500], flush=True)
    print("bad", bad, "of", len(sqls))
