"""Sources: metric tables, counter logs, event files, text logs, listings, remote tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from opskit.functions import clock
from opskit.operators.aggregates import union_sources
from opskit.operators.joins import broadcast_if_small
from opskit.operators.ordered import global_running_sum
from opskit.session import checkpoint_root, durable, scratch_path
from opskit.sources.records import records
from opskit.sources.schemas import TRACE

CPU_RING = """_id bigint,
 SchedulerMonitorEvent struct<SystemHealth: struct<ProcessUtilization: bigint, SystemIdle: bigint>>,
 SchedluerMonitorEvent struct<SystemHealth: struct<ProcessUtilization: bigint, SystemIdle: bigint>>"""


def read_metric(spark: SparkSession, path: str, ts: str, start, end, date_col: str | None = None) -> DataFrame:
    """Samples of a time range; literal bounds reach the scan, ``date_col`` prunes folders."""
    df = spark.read.parquet(path).filter(F.col(ts).between(start, end))
    if date_col is not None:
        df = df.filter(F.col(date_col).between(F.to_date(start), F.to_date(end)))
    return df


def read_counter_log(data: DataFrame, details: DataFrame, display: DataFrame) -> DataFrame:
    """Recorded counter values with their counter's names and the log's display name."""
    return data.join(broadcast_if_small(details), "counter_id").join(broadcast_if_small(display), "guid")


def read_xml_events(spark: SparkSession, path_glob: str, row_tag: str, schema: str, numbered: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    """Events of rolled-over XML files, numbered in (file, position) order.

    Every event is read; ``columns`` names the fields that are wanted, the others are not converted.
    A split is read by one task from its beginning to its end, so an event's number follows from
    its place in the split and the events of earlier splits, and no event is shuffled.
    """
    df = (
        spark.read.format("xml").options(rowTag=row_tag, attributePrefix="_", valueTag="_text").schema(schema).load(path_glob)
        .select(*(["*"] if columns is None else columns), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    )
    if not numbered:
        return df
    path = scratch_path(spark, "xml-numbered")
    placed = df.withColumn("pos", F.monotonically_increasing_id())
    placed.write.parquet(path)  # parse the files once
    placed = spark.read.schema(placed.schema).parquet(path)
    splits = placed.groupBy("file", "block").agg(F.min("pos").alias("start"), F.count("*").alias("events"))
    upto = global_running_sum(splits, "events", ["file", "block"], "upto")
    first = upto.select("file", "block", (F.col("upto") - F.col("events") - F.col("start") + 1).alias("first"))
    return placed.join(broadcast_if_small(first), ["file", "block"]).select(*[c for c in df.columns if c != "block"], (F.col("pos") + F.col("first")).alias("event_no"))


LOG_LINE = r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d(?:\.\d+)?)\s+(\S+)\s+(.*)$"


def read_log(spark: SparkSession, path_glob: str, contains: Sequence[str] = (), start=None, end=None) -> DataFrame:
    """Entries of current and archived text logs holding all search texts, in a time window.

    A line that does not begin with a time belongs to the entry before it (in the order of
    files and places); lines before the first entry are left out. Entries are cut and filtered in
    the tasks that read the files; only lines at the edges of file splits are brought together.
    """
    entry = records(spark, path_glob, head=LOG_LINE)
    for needle in contains:
        entry = entry.filter(F.col("text").contains(needle))
    first = F.substring_index("text", "\n", 1)
    part = lambda i: F.regexp_extract(first, LOG_LINE, i)
    rest = F.substr("text", F.char_length(first) + 1)  # further lines with their breaks
    d = entry.select(F.to_timestamp_ntz(part(1)).alias("log_date"), part(2).alias("process"), F.concat(part(3), rest).alias("text"))
    if start is not None:
        d = d.filter(F.col("log_date") >= start)
    if end is not None:
        d = d.filter(F.col("log_date") <= end)
    return d


def list_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """File listing (no content is read): name, folder, size, time, depth."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    return reader.load(path).select(
        F.substring_index("path", "/", -1).alias("name"), F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"),
        F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"),
        (F.size(F.split("path", "/")) - 1).alias("depth"))


def parse_delimited(df: DataFrame, col: str, sep: str, fields: Mapping[str, str], pattern: str | None = None) -> DataFrame:
    """Typed columns from delimited lines; ``pattern`` keeps matching lines only."""
    if pattern is not None:
        df = df.filter(F.col(col).rlike(pattern))
    parts = F.split(F.col(col), F.concat(F.lit("\\Q"), F.lit(sep), F.lit("\\E")))
    return df.withColumn("_p", parts).select(
        *[c for c in df.columns if c != col],
        *[F.trim(F.get("_p", F.lit(i))).try_cast(t).alias(n) for i, (n, t) in enumerate(fields.items())])


def read_remote(spark: SparkSession, url: str, table: str, column: str | None = None, lower=None, upper=None, parts: int = 1, **properties) -> DataFrame:
    """A table behind JDBC, read in parallel ranges of ``column`` when one is given."""
    if column is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=parts, properties=properties)


def read_documents(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """Documents of ``writers.write_documents``, one ``text`` per document."""
    return records(spark, path, head=f"^<{tag}[ >]").select("text")


def fan_out(spark: SparkSession, sources: Mapping[str, object], fn: Callable[[object], DataFrame], at_once: int = 8) -> tuple[DataFrame | None, DataFrame]:
    """Run one query per source; (stacked results with ``source_name``, failures).

    Every source is a job of its own, ``at_once`` of them together, whose result is written to
    the shared folder. A source that fails, when it is planned (missing path, wrong schema) or
    when it runs (broken file, failing cast), becomes an error row and does not stop the others.
    """

    def run(source) -> DataFrame | str:
        try:
            return durable(fn(source))
        except (PySparkException, Py4JJavaError) as e:
            cause = str(e.java_exception) if isinstance(e, Py4JJavaError) else str(e)
            return cause.split("\n")[0]

    checkpoint_root(spark)  # set once, not by the threads
    with ThreadPoolExecutor(at_once) as pool:
        results = dict(zip(sources, pool.map(inheritable_thread_target(spark)(run), sources.values()), strict=True))
    good = {k: r for k, r in results.items() if not isinstance(r, str)}
    failed = spark.createDataFrame([(k, r) for k, r in results.items() if isinstance(r, str)], "source_name string, error string")
    return (union_sources(good) if good else None), failed


def values_df(spark: SparkSession, rows, schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def time_dimension(spark: SparkSession, start, end, step_seconds: int = 10) -> DataFrame:
    """Instants from ``start`` to ``end`` (naive datetimes), generated in parallel."""
    n = int((end - start).total_seconds() // step_seconds) + 1
    base = F.lit(start.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return spark.range(n).select((base + F.make_dt_interval(secs=F.col("id") * step_seconds)).alias("time"))


def extend_time_dimension(existing: DataFrame, wanted: DataFrame) -> DataFrame:
    """Only the instants that are not there yet."""
    return wanted.join(existing.select("time"), "time", "left_anti")


def numbers(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n + 1).withColumnRenamed("id", "n")


def read_trace(spark: SparkSession, path: str) -> DataFrame:
    """A recorded statement trace with its fixed schema; quoted statements may have line breaks.

    Every file has a header. A file is read by many tasks: its records are cut where the number
    of quotes before a line is even.
    """
    row = F.from_csv("text", TRACE, {"escape": '"'}).alias("row")
    rows = records(spark, path, quote='"').filter(~F.col("first"))
    return rows.select(F.rtrim("text", F.lit("\r")).alias("text")).filter("trim(text) <> ''").select(row).select("row.*")


def parse_cpu_ring(df: DataFrame, record: str, stamp_ms: str, now_ms: str, now) -> DataFrame:
    """CPU samples from scheduler records; the event time counts back from now in ticks."""
    doc = F.from_xml(F.col(record), CPU_RING)
    health = lambda f: F.coalesce(
        F.col(f"doc.SchedulerMonitorEvent.SystemHealth.{f}"), F.col(f"doc.SchedluerMonitorEvent.SystemHealth.{f}"))
    back = (F.col(now_ms) - F.col(stamp_ms)).cast("bigint")
    at = F.timestamp_micros(clock.epoch_us(now) - back * 1000).cast("timestamp_ntz")
    return df.filter(F.col(record).contains("<SystemHealth>")).withColumn("doc", doc).select(
        *[c for c in df.columns if c != record], F.col("doc._id").alias("record_id"), at.alias("event_time"),
        (100 - health("SystemIdle")).alias("system_cpu"), health("ProcessUtilization").alias("process_cpu"))
