"""Compare registered reports with their SQL on DuckDB (also a command line tool)."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = [None if (v is None or (isinstance(v, float) and v != v) or v is pd.NaT or v is pd.NA) else v for v in df[c].tolist()]
        df[c] = df[c].astype(object)
    rows = sorted(([repr(x) for x in r] for r in df.itertuples(index=False, name=None)))
    return pd.DataFrame(rows, columns=df.columns)


def diff(spark_pdf: pd.DataFrame, sql_pdf: pd.DataFrame) -> str | None:
    if sorted(spark_pdf.columns) != sorted(sql_pdf.columns):
        return f"columns {sorted(spark_pdf.columns)} vs {sorted(sql_pdf.columns)}"
    if len(spark_pdf) != len(sql_pdf):
        return f"rows {len(spark_pdf)} vs {len(sql_pdf)}"
    a, b = canonical(spark_pdf), canonical(sql_pdf)
    if a.equals(b):
        return None
    bad = [i for i in range(len(a)) if list(a.iloc[i]) != list(b.iloc[i])][:2]
    return " | ".join(f"{list(a.iloc[i])} <> {list(b.iloc[i])}" for i in bad)


def main() -> int:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    sql = entry.oracle_sql()
    bad = 0
    for key, fn in entry.queries().items():
        if wanted and not any(key.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            got = fn(spark, sf).toPandas()
            took = time.time() - start
            if key in sql:
                why = diff(got, con.execute(sql[key]).df())
            else:
                why = None if len(got) else "no rows"
            tag = "ok" if why is None else "DIFF"
            note = "" if key in sql else " (no sql)"
            if len(got) == 0:
                note += " EMPTY"
        except Exception as e:  # noqa: BLE001 - report and go on
            tag, why, took, got, note = "FAIL", str(e)[:700], time.time() - start, [], ""
        if tag != "ok":
            bad += 1
        if tag != "ok" or "EMPTY" in note or os.environ.get("VERBOSE"):
            print(f"{tag} {key}{note} rows={len(got)} {took:.2f}s {why or ''}", flush=True)
    print(f"{bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sys.exit(main())
