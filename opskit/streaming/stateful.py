"""Stateful stream operators with their state in a table of the shared folder.

Each micro-batch reads the state its predecessor wrote, and writes its output and its own
state under its batch number.  A repeated batch overwrites the same folders, so results
are exactly-once after any failure.  The work of a batch is ordinary distributed SQL: a hot
key is cut into time slices like in the batch operators, and no Python runs on rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from opskit.operators.alerts import status_changes
from opskit.operators.joins import asof_join
from opskit.operators.ordered import null_safe_join, series_lag, top_per_key
from opskit.operators.reshape import reach
from opskit.session import durable
from opskit.streaming.ingest import drain_batches


class StateTable:
    """One folder per batch below ``root``; only the last two are kept."""

    def __init__(self, root: str):
        self.root = root

    def path(self, batch_id: int) -> str:
        return f"{self.root}/batch={batch_id}"

    def load(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        return spark.read.parquet(self.path(batch_id - 1)) if batch_id > 0 else None

    def save(self, state: DataFrame, batch_id: int) -> None:
        state.write.mode("overwrite").parquet(self.path(batch_id))
        if batch_id >= 2:
            sc = state.sparkSession.sparkContext
            old = sc._jvm.org.apache.hadoop.fs.Path(self.path(batch_id - 2))
            old.getFileSystem(sc._jsc.hadoopConfiguration()).delete(old, True)


#: (batch, state) to (output, new state); the new state may be a function of the written output.
Step = Callable[[DataFrame, "DataFrame | None"], "tuple[DataFrame, DataFrame | Callable[[DataFrame], DataFrame]]"]


def run_stateful(stream: DataFrame, step: Step, checkpoint: str, state_path: str, out_path: str) -> None:
    """Drive ``step(batch, state) -> (output, new state)`` over the available batches."""
    table = StateTable(state_path)

    def handle(batch: DataFrame, batch_id: int) -> None:
        out, state = step(batch, table.load(batch.sparkSession, batch_id))
        out.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
        if callable(state):  # from what was written, so that a batch is computed once
            state = state(batch.sparkSession.read.schema(out.schema).parquet(f"{out_path}/batch={batch_id}"))
        table.save(state, batch_id)

    drain_batches(stream, checkpoint, handle)


def _split_late(batch: DataFrame, state: DataFrame | None, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that continue their series, and rows at or before its last known sample."""
    if state is None:
        return batch, batch.limit(0)
    last = state.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_last"))
    j = null_safe_join(batch, last, list(keys), "left")
    late = F.coalesce(F.struct(*order) <= F.col("_last"), F.lit(False))
    return j.filter(~late).drop("_last"), j.filter(late).drop("_last")


def delta_step(keys: Sequence[str], ts: str, value: str, tie: str, on_reset: str = "restart") -> Step:
    """Change since the previous sample of the series, across batches.

    ``restart``: 0 for the first sample, the value itself after a fall; ``drop`` leaves the
    change of a fall empty.  Late rows come out with an empty change and ``late``.
    """

    def step(batch: DataFrame, state: DataFrame | None):
        cols = [*keys, ts, value, tie]
        good, late = _split_late(batch.select(*cols), state, keys, [ts, tie])
        rows = good.withColumn("_old", F.lit(False))
        if state is not None:
            rows = rows.unionByName(state.select(*cols).withColumn("_old", F.lit(True)))
        lagged = series_lag(rows, list(keys), [ts, tie], [value]).filter(~F.col("_old"))
        now, before = F.col(value), F.col(f"prev_{value}")
        fall = now if on_reset == "restart" else F.lit(None).cast("bigint")
        first = F.lit(0).cast("bigint") if on_reset == "restart" else F.lit(None).cast("bigint")
        delta = F.when(before.isNull(), first).when(now < before, fall).otherwise(now - before)
        out = lagged.select(*cols, delta.alias("delta"), F.lit(False).alias("late")).unionByName(
            late.select(*cols, F.lit(None).cast("bigint").alias("delta"), F.lit(True).alias("late")))
        rest = [c for c in cols if c not in keys]

        def newest(written: DataFrame) -> DataFrame:
            known = written.filter("not late").select(*cols)
            known = known if state is None else known.unionByName(state.select(*cols))
            return known.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(ts, tie)).alias("_s")).select(
                *keys, *[F.col(f"_s.{c}").alias(c) for c in rest])

        return out, newest

    return step


def flapping_step(key: str, ts: str, status: str, tie: str, n: int = 12, low: float = 0.35, high: float = 0.65) -> Step:
    """Share of status changes among the last ``n`` results of each check, after every batch.

    Results go by time and ``tie``. The state holds one result more than needed, as the
    predecessor of the oldest counted one.  A late result takes its place in time; only results
    older than a full state, which cannot be among the last ``n``, are left out.
    """

    def step(batch: DataFrame, state: DataFrame | None):
        place = F.struct(ts, tie)
        rows = batch.select(key, ts, tie, status).withColumn("_change", F.lit(None).cast("int"))
        if state is not None:
            full = state.groupBy(key).agg(F.min(place).alias("_oldest"), F.count("*").alias("_n")).filter(F.col("_n") > n)
            j = null_safe_join(rows, full, [key], "left")
            rows = j.filter(F.col("_oldest").isNull() | (place > F.col("_oldest"))).drop("_oldest", "_n")
            rows = rows.unionByName(state.select(key, ts, tie, status, F.col("status_change").alias("_change")))
        changes = status_changes(rows, key, ts, status, [tie])
        known = F.when(F.col(f"prev_{status}").isNull(), F.coalesce("_change", "status_change")).otherwise(F.col("status_change"))
        changes = changes.withColumn("status_change", known).select(key, ts, tie, status, "status_change")
        last = durable(top_per_key(changes, [key], [F.col(ts).desc(), F.col(tie).desc()], n + 1, "_rn"))  # for the output and the state
        ratio = last.filter(F.col("_rn") <= n).groupBy(key).agg(
            F.max(ts).alias(ts), F.count("*").alias("checks"), F.avg("status_change").alias("change_ratio"))
        return ratio.withColumn("is_flapping", F.col("change_ratio").between(low, high)), last.drop("_rn")

    return step


def suppress_step(key: str, ts: str, minutes: int) -> Step:
    """Alerts to send: the first one, then one only when the last notice is ``minutes`` old.

    Ages count minute boundaries, so alerts of one minute are equal and are merged first, to its
    first alert. Every minute points to the first one that is old enough after it (an as-of
    self join over time slices); the notices are the minutes reached from the first one that is
    due, found by doubling these pointers, so a hot key is split and its minutes are never
    brought together. The state is the minute of the last notice. Alerts older than it come
    out with ``late`` and change nothing.
    """

    def step(batch: DataFrame, state: DataFrame | None):
        minute = F.floor(F.unix_timestamp(F.col(ts)) / 60).cast("bigint")
        rows = batch.select(key, ts, minute.alias("_m"))
        known = None if state is None else state.select(key, "last_notice")
        if known is None:
            rows = rows.withColumn("last_notice", F.lit(None).cast("bigint"))
        else:
            rows = null_safe_join(rows, known, [key], "left")
        late = F.coalesce(F.col("_m") < F.col("last_notice"), F.lit(False))
        behind = rows.filter(late).select(key, ts, F.lit(True).alias("late"))
        due = rows.filter(F.col("last_notice").isNull() | (F.col("_m") >= F.col("last_notice") + minutes))
        per = durable(due.groupBy(key, "_m").agg(F.min(ts).alias(ts)))
        # "time" is the order that the series operators cut into slices
        at = lambda m: F.timestamp_seconds(m * 60)
        ends = per.select(key, "_m", at(F.col("_m") + minutes).alias("_from"))
        then = per.select(key, F.col("_m").alias("anc"), at(F.col("_m")).alias("_at"))
        after = asof_join(ends, then, [key], "_from", "_at", ["anc"], "forward")
        pointers = after.filter("anc is not null").select(key, F.col("_m").alias("node"), "anc")
        sent = reach(pointers, [key], per.groupBy(key).agg(F.min("_m").alias("node")))
        notices = null_safe_join(per, sent.withColumnRenamed("node", "_m"), [key, "_m"], "left_semi")
        out = notices.select(key, ts, F.lit(False).alias("late")).unionByName(behind)

        def newest(written: DataFrame) -> DataFrame:
            notices = written.filter("not late").select(key, minute.alias("last_notice"))
            notices = notices if known is None else notices.unionByName(known)
            return notices.groupBy(key).agg(F.max("last_notice").alias("last_notice"))

        return out, newest

    return step
