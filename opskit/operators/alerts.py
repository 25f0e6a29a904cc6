"""Thresholds, flapping, failures, heartbeats, replication latency and limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from opskit.functions import clock
from opskit.operators.joins import broadcast_if_small
from opskit.operators.ordered import first_per_key, null_safe_join, series_lag, top_per_key


def breaches(threshold: str, value: str) -> Column:
    """Does a value hit a rule such as ``>90``, ``<=5``, ``<>1`` or ``=3``?"""
    op = F.regexp_extract(threshold, r"^\s*(<>|<=|>=|<|>|=)", 1)
    limit = F.regexp_extract(threshold, r"(-?[0-9.]+)\s*$", 1).try_cast("double")
    v = F.col(value)
    return (
        F.when(op == "<>", v != limit).when(op == "<=", v <= limit).when(op == ">=", v >= limit)
        .when(op == "<", v < limit).when(op == ">", v > limit).when(op == "=", v == limit).otherwise(F.lit(False))
    )


def check_status(values: DataFrame, checks: DataFrame, key: str, value: str) -> DataFrame:
    """CRITICAL before WARNING before OK; a missing value is CHECK ERROR."""
    d = values.join(broadcast_if_small(checks), key)
    hit = lambda c: F.coalesce(breaches(c, value), F.lit(False))
    status = (
        F.when(F.col(value).isNull(), "CHECK ERROR").when(hit("critical"), "CRITICAL").when(hit("warning"), "WARNING").otherwise("OK")
    )
    return d.withColumn("check_status", status)


def status_changes(log: DataFrame, key: str, ts: str, status: str, tie: Sequence[str] = ()) -> DataFrame:
    """1 where the status differs from the previous check (also on the first one)."""
    d = series_lag(log, [key], [ts, *tie], [status])
    return d.withColumn("status_change", (~F.col(status).eqNullSafe(F.col(f"prev_{status}"))).cast("int"))


def flapping(
    log: DataFrame, key: str, ts: str, now, n: int = 12, hours: int = 6, low: float = 0.35, high: float = 0.65, tie: Sequence[str] = ()
) -> DataFrame:
    """Checks whose share of status changes in the last ``n`` results (within ``hours``) is near half.

    Results of one time go by ``tie``, and else by whether they are changes.
    """
    recent = log.filter((F.col(ts) > now - F.make_dt_interval(hours=F.lit(hours))) & (F.col(ts) <= now))
    last = top_per_key(recent, [key], [F.col(ts).desc(), *[F.col(c).desc() for c in [*tie, "status_change"]]], n)
    ratio = last.groupBy(key).agg(F.count("*").alias("checks"), F.avg("status_change").alias("change_ratio"))
    return ratio.withColumn("is_flapping", F.col("change_ratio").between(low, high))


def due_checks(config: DataFrame, meta: DataFrame, key: str, now) -> DataFrame:
    """Enabled checks whose last run is at least their frequency ago (never run counts as due)."""
    d = config.filter("enabled").join(meta, key, "left")
    age = clock.datediff_boundary("minute", F.coalesce("last_check", F.lit("1970-01-01").cast("timestamp_ntz")), now)
    return d.filter(age >= F.coalesce("frequency_minutes", F.lit(0)))


def consecutive_failures(history: DataFrame, key: str, run_id: str, status: str, n: int = 20, success: int = 1, compat: bool = False) -> DataFrame:
    """Runs newer than the latest success among the last ``n`` of each job.

    Without any success all of them count; ``compat`` gives 0 instead.
    """
    last = top_per_key(history, [key], [F.col(run_id).desc()], n, "_rn")
    newest_ok = F.min(F.when(F.col(status) == success, F.col("_rn")))
    none = F.lit(0).cast("bigint") if compat else F.count("*")
    return last.groupBy(key).agg(F.coalesce((newest_ok - 1).cast("bigint"), none).alias("failures"))


def alerts_due(history: DataFrame, suppress: DataFrame, key: str, run_id: str, status: str, n: int) -> DataFrame:
    """Jobs whose ``n`` latest runs all failed, none of them on the suppression list."""
    last = top_per_key(history, [key], [F.col(run_id).desc()], n, "_rn")
    open_ = last.filter(F.col(status) == 0).join(suppress.select(run_id), run_id, "left_anti")
    return open_.groupBy(key).agg(F.count("*").alias("failed")).filter(F.col("failed") >= n)


def stale(df: DataFrame, keys: Sequence[str], ts: str, minutes: int, now) -> DataFrame:
    """Entities whose last message is older than ``minutes``."""
    return df.groupBy(*keys).agg(F.max(ts).alias("last_update")).filter(
        F.col("last_update") < now - F.make_dt_interval(mins=F.lit(minutes)))


def last_progress(history: DataFrame, key: str, ts: str, status: str, now, started: int = 1, running: int = 3, default_hours: int = 48) -> DataFrame:
    """Last in-progress message at or after the last start (start defaults to 48 hours ago)."""
    starts = history.groupBy(key).agg(F.max(F.when(F.col(status) == started, F.col(ts))).alias("start_time")).withColumn(
        "start_time", F.coalesce("start_time", now - F.make_dt_interval(hours=F.lit(default_hours))))
    run = history.filter(F.col(status) == running).join(starts, key).filter(F.col(ts) >= F.col("start_time"))
    last = run.groupBy(key).agg(F.max(ts).alias("last_log"))
    return starts.join(last, key, "left").withColumn("last_log", F.coalesce("last_log", "start_time"))


def token_latency(header: DataFrame, arrivals: DataFrame, key: str) -> DataFrame:
    """Minutes (crossed) from publisher to distributor to subscriber."""
    return header.join(arrivals, key).withColumns({
        "distributor_latency": clock.datediff_boundary("minute", "publisher_commit", "distributor_commit"),
        "subscriber_latency": clock.datediff_boundary("minute", "distributor_commit", "subscriber_commit"),
        "overall_latency": clock.datediff_boundary("minute", "publisher_commit", "subscriber_commit"),
    })


def close_lost(tokens: DataFrame, publication: str = "publication") -> DataFrame:
    """Close open tokens older than the newest processed one of their publication."""
    newest = tokens.groupBy(publication).agg(F.max(F.when(F.col("is_processed"), F.col("publisher_commit"))).alias("_newest"))
    lost = ~F.col("is_processed") & F.coalesce(F.col("publisher_commit") < F.col("_newest"), F.lit(False))
    return tokens.join(newest, publication, "left").withColumn("lost", lost).withColumn(
        "is_processed", F.col("is_processed") | F.col("lost")).drop("_newest")


def current_latency(header: DataFrame, history: DataFrame, now, publication: str = "publication") -> DataFrame:
    """Oldest pending token per publication, else the latest finished one."""
    pending = first_per_key(header.filter(~F.col("is_processed")), [publication], ["id"]).select(
        publication, F.col("publisher_commit").alias("_pending"))
    done = first_per_key(history, [publication], [F.col("publisher_commit").desc(), F.col("subscriber_commit").desc(), F.col("id").desc()]).select(
        publication, "overall_latency")
    j = pending.join(done, publication, "full")
    active = F.col("_pending").isNotNull()
    return j.select(
        publication, F.when(active, "Active").otherwise("History").alias("token_state"),
        F.when(active, clock.datediff_boundary("minute", "_pending", now)).otherwise(F.col("overall_latency")).alias("current_latency"))


def token_rate(header: DataFrame, arrivals: DataFrame, key: str, now, hours: int = 2) -> DataFrame:
    """Tokens that have not arrived, or arrived within the last hours."""
    j = header.join(arrivals, key, "left")
    return j.filter(F.col("subscriber_commit").isNull() | (F.col("subscriber_commit") >= now - F.make_dt_interval(hours=F.lit(hours))))


def agent_errors(history: DataFrame, since, keys: Sequence[str], noise: str = "Skipped % error(s) when applying transactions at the Subscriber.") -> DataFrame:
    """Errors since a time, grouped by agent and comment, without the noise comment."""
    d = history.filter((F.col("error_id") != 0) & (F.col("time") >= since) & ~F.col("comments").like(noise))
    return d.groupBy(*keys, "comments").agg(F.max("time").alias("time"), F.max("error_id").alias("error_id"))


def limit_status(sessions: DataFrame, limits: DataFrame, program: str = "program_name", warn_share: float = 0.8) -> DataFrame:
    """Connections per program against its own or the ``default`` limit: BLOCK, WARN or nothing."""
    counts = sessions.filter(F.col(program).isNotNull()).groupBy(program).agg(F.count("*").alias("connections"))
    fallback = limits.filter(F.col(program) == "default").select("limit").scalar()
    d = counts.join(broadcast_if_small(limits), program, "left").withColumn("limit", F.coalesce("limit", fallback))
    action = F.when(F.col("connections") >= F.col("limit"), "BLOCK").when(F.col("connections") >= F.col("limit") * warn_share, "WARN")
    return d.withColumn("action", action).filter("action is not null")


# Row filter of each report kind.
ALERT_RULES = {
    "volume": "used_percent > 80",
    "backup": "full_backup_24h = 'No'",
    "replica": "health <> 'HEALTHY' or connection <> 'Connected'",
    "all": "true",
}


def alert_rows(kind: str, df: DataFrame) -> DataFrame:
    return df.filter(ALERT_RULES[kind])


def breach_count(df: DataFrame, value: str, x, n: int) -> DataFrame:
    """One row: how many series exceed ``x`` and whether that is enough to act."""
    return df.agg(F.count_if(F.col(value) >= x).alias("breaches")).withColumn("act", F.col("breaches") >= n)


def stuck_workflows(entries: DataFrame, main: str = "main") -> DataFrame:
    """Workflow steps held up by their main step: it waits for a resource, or it ended with an
    unknown error while the step still executes."""
    heads = entries.filter(F.col("job_name") == main).select(
        "setup_id", F.col("current_state").alias("main_state"), F.col("description").alias("main_description"))
    j = null_safe_join(entries.filter(F.col("job_name") != main), heads, ["setup_id"])
    return j.filter(
        (F.col("main_state") == "ResourceWait")
        | ((F.col("main_state") == "Completed") & (F.col("main_description") == "Unknown error (0xffffffff)") & (F.col("current_state") == "Executing"))
    )
