"""Streaming sources, sinks and the operators Structured Streaming has built in."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def file_stream(spark: SparkSession, path: str, schema, ts: str | None = None, per_trigger: int | None = None) -> DataFrame:
    """Parquet file stream; a zone-less ``ts`` becomes an instant so that it can carry a watermark."""
    reader = spark.readStream.schema(schema)
    if per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    df = reader.parquet(path)
    return df if ts is None else df.withColumn(ts, F.col(ts).cast("timestamp"))


def drain(stream: DataFrame, checkpoint: str, path: str, partition_by: Sequence[str] = ()) -> None:
    """Process everything available into a Parquet table (exactly once), then stop."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()


def drain_batches(stream: DataFrame, checkpoint: str, fn: Callable[[DataFrame, int], None]) -> None:
    """Run ``fn(batch, batch_id)`` on every micro-batch of what is available, then stop."""
    (stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


def ingest(stream: DataFrame, ts: str, checkpoint: str, path: str) -> None:
    """Collector: append new rows to a table partitioned by day."""
    drain(stream.withColumn("date", F.to_date(ts)), checkpoint, path, ["date"])


def ingest_dedup(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First arrival of each key; repeats within the delay are ignored."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_rollup(stream: DataFrame, keys: Sequence[str], ts: str, minutes: int, delay: str, value: str) -> DataFrame:
    """Sum and count per closed bucket and series; a bucket is final once the watermark passed it."""
    bucket = F.window(ts, f"{minutes} minutes")
    return (
        stream.withWatermark(ts, delay).groupBy(bucket, *keys)
        .agg(F.sum(value).alias("total"), F.count("*").alias("samples"))
        .select(F.col("window.start").alias("bucket"), *keys, "total", "samples")
    )


def stream_heartbeat(stream: DataFrame, keys: Sequence[str], ts: str, minutes: int, delay: str) -> DataFrame:
    """Silence alerts: activity that ended and was followed by ``minutes`` without a message.

    A session window closes exactly when its key stayed silent that long.  Sessions are
    merged inside each input partition before the shuffle, so a hot key arrives condensed.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    gap = f"{minutes} minutes"
    return (
        stream.withWatermark(ts, delay).groupBy(F.session_window(ts, gap), *keys).agg(F.count("*").alias("messages"))
        .select(*keys, F.col("session_window.start").alias("first_seen"),
                (F.col("session_window.end") - F.expr(f"interval {gap}")).alias("last_seen"), "messages")
    )


def stream_token_latency(sent: DataFrame, arrived: DataFrame, key: str, max_delay: str, delay: str) -> DataFrame:
    """Match sent tokens (``sent_at``) with arrivals (``arrived_at``) inside the longest delay.

    Tokens without an arrival come out with NULLs once the watermark has passed their time:
    they are lost.
    """
    s = sent.withWatermark("sent_at", delay)
    a = arrived.withColumnRenamed(key, "_key").withWatermark("arrived_at", delay)
    cond = (F.col(key) == F.col("_key")) & (F.col("arrived_at") >= F.col("sent_at")) & (
        F.col("arrived_at") <= F.col("sent_at") + F.expr(f"interval {max_delay}"))
    return s.join(a, cond, "left_outer").withColumn("lost", F.col("_key").isNull()).drop("_key")


def xml_stream(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """Event files read as they roll over."""
    return spark.readStream.format("xml").options(rowTag=row_tag, attributePrefix="_").schema(schema).load(path)


def consume_queue(stream: DataFrame, key: str, checkpoint: str, log_path: str, action: Callable[[DataFrame, int], None]) -> None:
    """Log every message; call ``action(distinct keys, batch_id)`` once per drain.

    The log of a batch is replaced when the batch is repeated.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log_path}/batch={batch_id}")
        logged = batch.sparkSession.read.parquet(f"{log_path}/batch={batch_id}")
        action(logged.select(key).distinct(), batch_id)

    drain_batches(stream, checkpoint, handle)


def late_counter(stream: DataFrame, ts: str, delay_minutes: int, checkpoint: str, metrics_path: str) -> None:
    """Rows and late rows of every batch: late means older than the newest time of all
    earlier batches minus the delay.  The metrics table itself is the memory."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id == 0:
            edge = F.lit(None).cast("timestamp")
        else:
            seen = spark.read.parquet(*[f"{metrics_path}/batch={i}" for i in range(max(0, batch_id - 1), batch_id)])
            edge = seen.agg(F.max("newest") - F.expr(f"interval {delay_minutes} minutes")).scalar()
        b = batch.withColumn("_edge", edge)
        out = b.agg(
            F.count("*").alias("total_rows"), F.count_if(F.coalesce(F.col(ts) < F.col("_edge"), F.lit(False))).alias("late_rows"), F.max(ts).alias("newest"))
        if batch_id > 0:
            out = out.withColumn("newest", F.greatest("newest", seen.agg(F.max("newest")).scalar()))
        out.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{metrics_path}/batch={batch_id}")

    drain_batches(stream, checkpoint, handle)
