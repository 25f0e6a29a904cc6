"""Session snapshots: blocking, execution spans, program load, jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from opskit.functions import clock, text
from opskit.operators.ordered import first_per_key, null_safe_join
from opskit.operators.reshape import ancestors, below_counts, hierarchy, tree_label

SNAP = "collection_time"


def resolve_job_name(df: DataFrame, program: str, jobs: DataFrame, job_id: str, job_name: str) -> DataFrame:
    """Replace ``... JobStep 0x<id> : n`` programs by the job's name (a derived equi key).

    Ids are hexadecimal and agree in their last ten digits; ``job_id`` is hex text or a number.
    """
    last = lambda c: F.upper(F.substring(F.lpad(c, 64, "0"), -10, 10))
    found = F.regexp_extract(program, r"JobStep 0x([0-9A-Fa-f]+)", 1)
    key = F.when(found != "", last(found))
    own = F.col(job_id) if dict(jobs.dtypes)[job_id] == "string" else F.hex(job_id)
    names = jobs.select(last(own).alias("_job"), F.col(job_name).alias("_name"))
    named = df.withColumn("_key", key).join(names, F.col("_key") == F.col("_job"), "left")
    shown = F.coalesce(F.concat(F.lit("Job = "), F.col("_name")), F.col(program))
    return named.withColumn(program, shown).drop("_key", "_job", "_name")


def active_counts(df: DataFrame, ts: str = SNAP) -> DataFrame:
    return df.groupBy(ts).agg(F.count("*").alias("sessions"))


def blocking_tree(sessions: DataFrame, body: str = "sql_command") -> DataFrame:
    """One line per session of a blocking tree and snapshot; cycles are kept and marked."""
    tree = hierarchy(sessions, [SNAP], "session_id", "blocking_session_id")
    info = sessions.select(SNAP, F.col("session_id").alias("node"), F.col(body).alias("_body"), "wait_info")
    lines = null_safe_join(tree, info, [SNAP, "node"], "left")
    wait = text.lock_wait("wait_info")
    return lines.select(
        SNAP, F.col("node").alias("session_id"), F.col("parent").alias("blocking_session_id"), "head", "depth", "path", "cycle",
        tree_label("depth", "node", F.coalesce("_body", F.lit(""))).alias("blocking_tree"),
        wait["type"].alias("lock_type"), F.floor(wait["max_ms"] / 1000).alias("lock_seconds"),
    )


def blocked_over(sessions: DataFrame, threshold_ms: int) -> DataFrame:
    """Sessions blocked at least that long, and the sessions that block them."""
    blocked = sessions.filter("blocking_session_id is not null").withColumn("wait_ms_max", text.max_wait_ms("wait_info"))
    victims = blocked.filter(F.col("wait_ms_max") >= threshold_ms)
    heads = victims.select(SNAP, F.col("blocking_session_id").alias("session_id")).distinct()
    blockers = sessions.join(heads, [SNAP, "session_id"], "left_semi")
    pick = [SNAP, "session_id", "blocking_session_id"]
    return victims.select(*pick, F.floor(F.col("wait_ms_max") / 60000).alias("waiting_minutes")).unionByName(
        blockers.select(*pick, F.lit(None).cast("bigint").alias("waiting_minutes"))
    )


def consistent_blocking(sessions: DataFrame, minutes: int, now) -> DataFrame:
    """Same (session, blocker) pair in the latest snapshot and the latest one at least
    ``minutes`` older, for sessions that run at least that long."""
    seen = sessions.filter(F.col(SNAP) <= now)
    latest = seen.agg(F.max(SNAP)).scalar()
    pairs = seen.filter("blocking_session_id is not null").withColumn("_latest", latest)
    older = F.col(SNAP) < F.col("_latest")
    age = clock.datediff_boundary("minute", SNAP, "_latest")
    second = seen.withColumn("_latest", latest).filter(older & (age >= minutes)).agg(F.max(SNAP)).scalar()
    now_rows = pairs.filter((F.col(SNAP) == F.col("_latest")) & (F.col("minutes") >= minutes)).drop("_latest")
    then = pairs.withColumn("_second", second).filter(F.col(SNAP) == F.col("_second")).select(
        "session_id", "blocking_session_id"
    ).distinct()
    return now_rows.join(then, ["session_id", "blocking_session_id"], "left_semi")


def job_blockers(sessions: DataFrame, program: str, start, end) -> DataFrame:
    """All sessions above the named program's sessions in the snapshots of a period."""
    window = sessions.filter(F.col(SNAP).between(start, end))
    seeds = window.filter(F.col("program_name") == program).select(SNAP, F.col("session_id").alias("node"))
    return ancestors(window, [SNAP], "session_id", "blocking_session_id", seeds).withColumnRenamed("node", "session_id")


def execution_spans(df: DataFrame, keys, ts: str = SNAP) -> DataFrame:
    """First and last sighting of each execution and the minutes between (boundaries crossed)."""
    return df.groupBy(*keys).agg(F.min(ts).alias("started"), F.max(ts).alias("finished"), F.count("*").alias("seen")).withColumn(
        "minutes", clock.datediff_boundary("minute", "started", "finished")
    )


def longest_tran(sessions: DataFrame, keys, minutes: int, tie=()) -> DataFrame:
    """Longest open transaction per key among those older than ``minutes``."""
    age = clock.datediff_boundary("minute", "tran_start_time", SNAP)
    old = sessions.withColumn("tran_minutes", age).filter((F.col("open_tran_count") > 0) & (F.col("tran_minutes") > minutes))
    return first_per_key(old, keys, [F.col("tran_minutes").desc(), *tie])


def persistent_sessions(sessions: DataFrame, keys) -> DataFrame:
    """Keys seen more often than there are snapshots."""
    snapshots = sessions.agg(F.countDistinct(SNAP)).scalar()
    return sessions.groupBy(*keys).agg(F.count("*").alias("seen")).filter(F.col("seen") > snapshots)


def program_load(requests: DataFrame, tasks: DataFrame, all_schedulers: int | Column) -> DataFrame:
    """Requests, tasks and share of distinct schedulers per (pool, program)."""
    per_request = tasks.groupBy("request_id").agg(F.count("*").alias("tasks"))
    load = (
        requests.join(per_request, "request_id", "left")
        .groupBy("pool", "program_name")
        .agg(F.count("*").alias("active_requests"), F.sum(F.coalesce("tasks", F.lit(0))).alias("num_tasks"))
    )
    used = (
        requests.select("request_id", "pool", "program_name")
        .join(tasks.select("request_id", "scheduler_id"), "request_id")
        .groupBy("pool", "program_name")
        .agg(F.countDistinct("scheduler_id").alias("num_schedulers"))
    )
    total = F.lit(all_schedulers) if isinstance(all_schedulers, int) else all_schedulers
    return load.join(used, ["pool", "program_name"]).withColumn(
        "scheduler_percent", F.floor(F.col("num_schedulers") * 100.0 / total)
    )


def blocked_count(sessions: DataFrame) -> DataFrame:
    """Sessions under each session of a snapshot, at all levels."""
    below = below_counts(sessions, [SNAP], "session_id", "blocking_session_id")
    return below.withColumnRenamed("node", "session_id").withColumnRenamed("below", "blocked_session_count")


def indirect_use(sessions: DataFrame, database: str, locks: str = "locks") -> DataFrame:
    """Sessions of other databases whose lock document names ``database``."""
    hit = F.expr(f"xpath_boolean({locks}, '//Database[@name=\"{database}\"]')")
    return sessions.filter((F.col("database_name") != database) & hit)


def running_jobs(activity: DataFrame, steps: DataFrame, schedules: DataFrame, now) -> DataFrame:
    """Open executions of the newest scheduler session with their current step."""
    newest = activity.agg(F.max("scheduler_session")).scalar()
    started = activity.filter(
        (F.col("scheduler_session") == newest) & F.col("start_time").isNotNull() & F.col("stop_time").isNull()
    ).withColumn("step_id", F.coalesce("last_step_id", F.lit(0)) + 1)
    seconds = (clock.epoch_us(now) - clock.epoch_us("start_time")) / 1_000_000
    return (
        started.join(steps, ["job_name", "step_id"])
        .join(schedules, "job_name", "left")
        .withColumn("elapsed", clock.fmt_duration(F.floor(seconds)))
        .withColumn("minutes_to_next", clock.datediff_boundary("minute", now, "next_run_time"))
    )
