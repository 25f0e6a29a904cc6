"""Registry of the ready-made reports: one entry per operator, bound to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


class Db:
    """The given parquet tables as attributes; nothing is read until a plan runs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir

    def path(self, table: str) -> str:
        return f"{self.dir}/{table}.parquet"

    def __getattr__(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))


def tidy(df: DataFrame) -> DataFrame:
    """One type per family (bigint, double, text) so results compare across engines."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, TS_TEXT)
        out.append(c.alias(f.name))
    return df.select(*out)


def report(key: str, sql: str | None = None):
    """Register ``fn(db) -> DataFrame`` under ``key`` with its SQL equivalent."""

    def add(fn: Callable[[Db], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"duplicate report {key}")
        QUERIES[key] = lambda spark, sf_dir: tidy(fn(Db(spark, sf_dir)))
        if sql is not None:
            SQL[key] = sql.strip()
        return fn

    return add


def stamp(expr: str) -> str:
    """SQL text of a timestamp in the same form as ``tidy``."""
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"
