"""Predicates and row selection."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from opskit.functions import text
from opskit.operators.ordered import first_per_key

# Wait types that are idle by nature and left out of wait reports.
IGNORABLE_WAITS = (
    "BROKER_EVENTHANDLER BROKER_RECEIVE_WAITFOR BROKER_TASK_STOP BROKER_TO_FLUSH BROKER_TRANSMITTER "
    "CHECKPOINT_QUEUE CHKPT CLR_AUTO_EVENT CLR_MANUAL_EVENT CLR_SEMAPHORE CXCONSUMER "
    "DBMIRROR_DBM_EVENT DBMIRROR_EVENTS_QUEUE DBMIRROR_WORKER_QUEUE DBMIRRORING_CMD "
    "DIRTY_PAGE_POLL DISPATCHER_QUEUE_SEMAPHORE EXECSYNC FSAGENT FT_IFTS_SCHEDULER_IDLE_WAIT FT_IFTSHC_MUTEX "
    "HADR_CLUSAPI_CALL HADR_FILESTREAM_IOMGR_IOCOMPLETION HADR_LOGCAPTURE_WAIT HADR_NOTIFICATION_DEQUEUE "
    "HADR_TIMER_TASK HADR_WORK_QUEUE "
    "KSOURCE_WAKEUP LAZYWRITER_SLEEP LOGMGR_QUEUE MEMORY_ALLOCATION_EXT ONDEMAND_TASK_QUEUE "
    "PARALLEL_REDO_DRAIN_WORKER PARALLEL_REDO_LOG_CACHE PARALLEL_REDO_TRAN_LIST PARALLEL_REDO_WORKER_SYNC "
    "PARALLEL_REDO_WORKER_WAIT_WORK PREEMPTIVE_XE_GETTARGETSTATE PWAIT_ALL_COMPONENTS_INITIALIZED "
    "PWAIT_DIRECTLOGCONSUMER_GETNEXT QDS_PERSIST_TASK_MAIN_LOOP_SLEEP QDS_ASYNC_QUEUE "
    "QDS_CLEANUP_STALE_QUERIES_TASK_MAIN_LOOP_SLEEP QDS_SHUTDOWN_QUEUE REDO_THREAD_PENDING_WORK "
    "REQUEST_FOR_DEADLOCK_SEARCH RESOURCE_QUEUE SERVER_IDLE_CHECK SLEEP_BPOOL_FLUSH SLEEP_DBSTARTUP "
    "SLEEP_DCOMSTARTUP SLEEP_MASTERDBREADY SLEEP_MASTERMDREADY SLEEP_MASTERUPGRADED SLEEP_MSDBSTARTUP "
    "SLEEP_SYSTEMTASK SLEEP_TASK SLEEP_TEMPDBSTARTUP SNI_HTTP_ACCEPT SOS_WORK_DISPATCHER "
    "SP_SERVER_DIAGNOSTICS_SLEEP SQLTRACE_BUFFER_FLUSH SQLTRACE_INCREMENTAL_FLUSH_SLEEP SQLTRACE_WAIT_ENTRIES "
    "WAIT_FOR_RESULTS WAITFOR WAITFOR_TASKSHUTDOWN WAIT_XTP_RECOVERY WAIT_XTP_HOST_WAIT "
    "WAIT_XTP_OFFLINE_CKPT_NEW_LOG WAIT_XTP_CKPT_CLOSE XE_DISPATCHER_JOIN XE_DISPATCHER_WAIT XE_TIMER_EVENT"
).split()

# Code tables.
BACKUP_TYPES = {"D": "Database", "I": "Differential", "L": "Log"}
RUN_STATUS = {0: "Failed", 1: "Succeeded", 2: "Retry", 3: "Canceled"}


def exclude_values(df: DataFrame, col: str, names) -> DataFrame:
    return df.filter(~F.col(col).isin(list(names)))


def between_time(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Literal bounds on the bare column, so they reach the scan."""
    return df.filter(F.col(ts).between(start, end))


def contains(df: DataFrame, col: str, needle: str) -> DataFrame:
    return df.filter(F.col(col).contains(needle))


def like_escaped(df: DataFrame, col: str, pattern: str, escape: str = "!") -> DataFrame:
    return df.filter(F.expr(f"`{col}` LIKE '{pattern}' ESCAPE '{escape}'"))


def any_pattern(pairs) -> Column:
    """OR of (column = LIKE pattern) groups; ``pairs`` is a list of {column: pattern}."""
    one = lambda rule: reduce(lambda a, b: a & b, [text.norm(c).like(p) for c, p in rule.items()])
    return reduce(or_, [one(rule) for rule in pairs])


def match_patterns(df: DataFrame, pairs) -> DataFrame:
    return df.filter(any_pattern(pairs))


def optional_filters(df: DataFrame, **wanted) -> DataFrame:
    """Equality filters; None or empty text means no restriction."""
    for col, value in wanted.items():
        if value is not None and value != "":
            df = df.filter(F.col(col) == value)
    return df


def isin_csv(col: str, csv: str, negate: bool = False) -> Column:
    hit = F.col(col).isin([v.strip() for v in csv.split(",") if v.strip()])
    return ~hit if negate else hit


def at_latest(df: DataFrame, ts: str) -> DataFrame:
    """Rows at the newest instant; the maximum is a one-value subquery."""
    return df.filter(F.col(ts) == df.agg(F.max(ts)).scalar())


def short_text(df: DataFrame, col: str, n: int) -> DataFrame:
    return df.filter(text.trimmed_length(col) < n)


def drop_noise(df: DataFrame, col: str, patterns) -> DataFrame:
    return df.filter(~F.col(col).rlike("|".join(patterns)))


def sample_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` repeatable pseudo-random rows (a top-k over a hash of the key)."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"/{seed}"))), key).limit(n)


def decode(col: str, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(F.col(col) == k, v) if out is None else out.when(F.col(col) == k, v)
    return out.otherwise(F.lit(default))


def active_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions that block, are blocked, run a request or hold an open transaction.

    Columns used: session_id, blocking_session_id, status, has_request, open_tran_count.
    """
    blockers = sessions.filter("blocking_session_id is not null").select(
        F.col("blocking_session_id").alias("session_id")
    ).distinct().withColumn("blocks", F.lit(True))
    user = F.col("session_id") > 50
    keep = (
        F.coalesce("blocks", F.lit(False))
        | (F.coalesce("blocking_session_id", F.lit(0)) != 0)
        | (user & F.col("has_request") & (F.col("status") != "sleeping"))
        | (user & (F.coalesce("open_tran_count", F.lit(0)) > 0))
    )
    return sessions.join(blockers, "session_id", "left").filter(keep).drop("blocks")


def changed_since(df: DataFrame, keys, ts: str, since) -> DataFrame:
    return df.filter(F.col(ts) >= since).select(*keys).distinct()


def one_per_bucket(df: DataFrame, ts: str, bucket: Column, keys=(), tie=()) -> DataFrame:
    """First sample of every bucket (and key)."""
    return first_per_key(df.withColumn("bucket", bucket), [*keys, "bucket"], [ts, *tie])
