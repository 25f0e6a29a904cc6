"""Event documents: shredding, blocking, deadlocks, errors, slow statements."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from opskit.functions import text
from opskit.operators.aggregates import collapse_max
from opskit.operators.filters import any_pattern, decode, isin_csv
from opskit.operators.ordered import global_rank

XML = {"valueTag": "_text", "attributePrefix": "_"}

EVENT_SCHEMA = """_name string, _timestamp string,
 data array<struct<_name: string, value: string, text: string>>,
 action array<struct<_name: string, value: string>>"""

_PROCESS = """struct<_id: string, _spid: bigint, _status: string, _waitresource: string, _waittime: bigint,
 _transactionname: string, _lockMode: string, _trancount: int, _clientapp: string, _hostname: string,
 _loginname: string, _isolationlevel: string, _currentdb: string, inputbuf: string>"""
BLOCK_SCHEMA = f"""_name string, _timestamp string,
 data array<struct<_name: string, value: struct<_text: string,
  `blocked-process-report`: struct<`blocked-process`: struct<process: {_PROCESS}>, `blocking-process`: struct<process: {_PROCESS}>>>>>"""

_PARTY = "array<struct<_id: string, _mode: string, _requestType: string>>"
_LOCK = f"""array<struct<_id: string, _hobtid: bigint, _objectname: string, _indexname: string, _mode: string, _WaitType: string,
 `owner-list`: struct<owner: {_PARTY}>, `waiter-list`: struct<waiter: {_PARTY}>>>"""
DEADLOCK_SCHEMA = f"""_name string, _timestamp string, data array<struct<_name: string, value: struct<deadlock: struct<
 `victim-list`: struct<victimProcess: array<struct<_id: string>>>,
 `process-list`: struct<process: array<{_PROCESS}>>,
 `resource-list`: struct<exchangeEvent: {_LOCK}, keylock: {_LOCK}, pagelock: {_LOCK}, objectlock: {_LOCK}>>>>>"""


def parse(df: DataFrame, col: str, schema: str) -> DataFrame:
    """Parse the document once; ``time`` is its timestamp.

    The one-element explode keeps later filters from being rewritten into further parses.
    """
    doc = F.explode(F.array(F.from_xml(F.col(col), schema, XML)))
    return df.select("*", doc.alias("doc")).withColumn("time", F.to_timestamp_ntz(F.col("doc._timestamp")))


def data_value(name: str, part: str = "value", section: str = "data") -> Column:
    """First named data (or action) item of a parsed flat event."""
    return F.get(F.filter(F.col(f"doc.{section}"), lambda d: d["_name"] == name), F.lit(0))[part]


def action_value(name: str) -> Column:
    return data_value(name, "value", "action")


def in_period(df: DataFrame, start=None, end=None) -> DataFrame:
    if start is not None:
        df = df.filter(F.col("time") >= start)
    if end is not None:
        df = df.filter(F.col("time") <= end)
    return df


def _without_app(df: DataFrame, app: str | None) -> DataFrame:
    return df if not app else df.filter(~F.coalesce("client_app_name", F.lit("")).contains(app))


def _seconds(name: str) -> Column:
    return (data_value(name).cast("double") / 1_000_000).cast("decimal(10,2)")


def events_slow(df: DataFrame, col: str, start=None, end=None, exclude_app: str | None = None, names: Sequence[str] = ()) -> DataFrame:
    """Statement events with CPU and duration in seconds, reads, writes and rows."""
    p = parse(df, col, EVENT_SCHEMA)
    if names:
        p = p.filter(F.col("doc._name").isin(list(names)))
    out = in_period(p, start, end).select(
        *df.drop(col).columns, F.col("doc._name").alias("event_name"), "time", _seconds("cpu_time").alias("cpu_time"),
        _seconds("duration").alias("duration"), data_value("logical_reads").cast("bigint").alias("logical_reads"),
        data_value("writes").cast("bigint").alias("writes"), data_value("row_count").cast("bigint").alias("row_count"),
        data_value("statement").alias("statement"), action_value("client_app_name").alias("client_app_name"),
        action_value("session_id").cast("bigint").alias("session_id"), action_value("database_name").alias("database_name"),
    )
    return _without_app(out, exclude_app)


def events_timeout(df: DataFrame, col: str, start=None, end=None, exclude_app: str | None = None) -> DataFrame:
    """Statements that the client gave up on (result 2, text Abort)."""
    p = in_period(parse(df, col, EVENT_SCHEMA), start, end).filter(data_value("result") == "2")
    out = p.select(
        *df.drop(col).columns, "time", _seconds("duration").alias("duration"), data_value("result", "text").alias("result_text"),
        data_value("statement").alias("statement"), action_value("client_app_name").alias("client_app_name"),
    )
    return _without_app(out, exclude_app)


def events_error(
    df: DataFrame, col: str, start=None, end=None, numbers: str = "", not_numbers: str = "", message: str = "", exclude_app: str | None = None
) -> DataFrame:
    """Error events; number lists are comma separated and empty means no restriction."""
    out = in_period(parse(df, col, EVENT_SCHEMA), start, end).filter(F.col("doc._name") == "error_reported").select(
        *df.drop(col).columns, "time", data_value("error_number").alias("error_number"), data_value("severity").cast("bigint").alias("severity"),
        data_value("state").cast("bigint").alias("state"), data_value("message").alias("message"),
        action_value("client_app_name").alias("client_app_name"), action_value("database_name").alias("database_name"),
    )
    if numbers:
        out = out.filter(isin_csv("error_number", numbers))
    if not_numbers:
        out = out.filter(isin_csv("error_number", not_numbers, negate=True))
    if message:
        out = out.filter(F.col("message").contains(message))
    return _without_app(out.withColumn("error_number", F.col("error_number").cast("bigint")), exclude_app)


def events_blocking(df: DataFrame, col: str, start=None, end=None) -> DataFrame:
    """Blocked and blocking processes, one row per (time, spid), numbered by time."""
    p = in_period(parse(df, col, BLOCK_SCHEMA), start, end)
    pick = lambda n: F.get(F.filter(F.col("doc.data"), lambda d: d["_name"] == n), F.lit(0))["value"]
    rep = pick("blocked_process")["blocked-process-report"]
    blocked, blocker = rep["blocked-process"]["process"], rep["blocking-process"]["process"]
    seconds = (pick("duration")["_text"].cast("bigint") / 1_000_000).cast("decimal(10,2)")

    def row(proc: Column, is_blocked: int, duration: Column, by: Column) -> Column:
        full = is_blocked == 1
        return F.struct(
            duration.cast("decimal(10,2)").alias("block_duration"), F.lit(is_blocked).alias("is_blocked"), proc["_spid"].alias("spid"),
            by.cast("bigint").alias("blocking_spid"), proc["_status"].alias("status"),
            (proc["_id"] if full else F.lit("")).alias("process_id"), proc["_waitresource"].alias("wait_resource"),
            proc["_waittime"].alias("wait_time"), proc["_clientapp"].alias("client_app"), proc["_hostname"].alias("host_name"),
            proc["_loginname"].alias("login_name"), proc["_currentdb"].alias("database_id"), proc["inputbuf"].alias("input_buffer"),
            (proc["_lockMode"] if full else F.lit("")).alias("lock_mode"),
        )

    both = F.array(row(blocked, 1, seconds, blocker["_spid"]), row(blocker, 0, F.lit(None), F.lit(None)))
    rows = p.select("time", F.inline(both)).filter("spid is not null")
    return global_rank(collapse_max(rows, ["time", "spid"]), ["time"], "block_group")


def events_deadlock(df: DataFrame, col: str, start=None, end=None) -> DataFrame:
    """Lock owners and waiters of every deadlock with their process, lock and victim flag.

    Everything needed sits in one document, so it is resolved inside the row.  When a
    document lists several kinds of locks the first kind of (exchange, key, page, object)
    is reported.
    """
    p = in_period(parse(df, col, DEADLOCK_SCHEMA), start, end)
    dead = F.filter(F.col("doc.data"), lambda d: d["value"]["deadlock"].isNotNull())
    p = p.withColumn("dl", F.get(dead, F.lit(0))["value"]["deadlock"]).filter("dl is not null")
    res = F.col("dl.resource-list")
    tag = lambda kind: F.transform(res[kind], lambda k: F.struct(F.lit(kind).alias("kind"), k.alias("lock")))
    locks = F.coalesce(*[F.when(F.size(res[k]) > 0, tag(k)) for k in ("exchangeEvent", "keylock", "pagelock", "objectlock")])
    key = lambda k: F.coalesce(k["lock"]["_hobtid"].cast("string"), k["lock"]["_id"])
    empty = F.array().cast(_PARTY)
    parties = lambda k: F.concat(
        F.coalesce(k["lock"]["owner-list"]["owner"], empty), F.coalesce(k["lock"]["waiter-list"]["waiter"], empty))
    p = p.withColumn("locks", locks).withColumn(
        "objects", F.array_join(F.array_sort(F.array_distinct(F.transform("locks", lambda k: k["lock"]["_objectname"]))), ", "))
    p = p.withColumn("l", F.explode("locks"))
    same = F.filter("locks", lambda k: key(k) == key(F.col("l")))
    p = p.withColumn("o", F.explode(F.flatten(F.transform(same, parties))))
    proc = F.get(F.filter(F.col("dl.process-list.process"), lambda x: x["_id"] == F.col("o._id")), F.lit(0))
    victims = F.transform(F.col("dl.victim-list.victimProcess"), lambda v: v["_id"])
    p = p.withColumn("p", proc).filter("p is not null")
    return p.select(
        *df.drop(col).columns, "time", "objects", F.col("l.kind").alias("lock_kind"), F.col("l.lock._objectname").alias("object_name"),
        F.col("l.lock._indexname").alias("index_name"), F.col("o._id").alias("process_id"),
        F.coalesce(F.array_contains(victims, F.col("o._id")), F.lit(False)).alias("victim"), F.col("l.lock._mode").alias("owner_mode"),
        F.col("o._mode").alias("request_mode"), F.col("p._lockMode").alias("lock_mode"), F.col("o._requestType").alias("request_type"),
        F.col("p._status").alias("status"), F.col("p._loginname").alias("login_name"), F.col("p.inputbuf").alias("input_buffer"),
    )


def role_switches(df: DataFrame, col: str, shift_hours: int = 0, kind: str = "availability_replica_state_change") -> DataFrame:
    """State changes of replicas in local time."""
    p = parse(df, col, EVENT_SCHEMA).filter(F.col("doc._name") == kind)
    return p.select(
        *df.drop(col).columns, (F.col("time") + F.make_dt_interval(hours=F.lit(shift_hours))).alias("time"),
        data_value("availability_group_name").alias("group_name"), data_value("previous_state", "text").alias("previous_state"),
        data_value("current_state", "text").alias("current_state"),
    )


def plans_with(df: DataFrame, plan: str, xpaths: Sequence[str], now, executions: str, measures: Mapping[str, str], created: str) -> DataFrame:
    """Statements whose plan document contains all nodes, with per-execution averages."""
    from opskit.functions.clock import datediff_boundary
    from opskit.functions.units import int_div

    d = df
    for x in xpaths:
        d = d.filter(F.expr(f"xpath_boolean({plan}, '{x}')"))
    hours = F.greatest(datediff_boundary("hour", created, now), F.lit(1))
    d = d.withColumn("executions_per_hour", (F.col(executions) / hours).cast("decimal(18,2)"))
    return d.withColumns({f"{n}_per_execution": int_div(c, executions) for n, c in measures.items()})


def event_rules(df: DataFrame, include: Sequence[dict], exclude_prefixes: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows matching some (column, pattern) pair and starting with none of the prefixes."""
    out = df.filter(any_pattern(include))
    for col, prefixes in exclude_prefixes.items():
        for prefix in prefixes:
            out = out.filter(~F.col(col).startswith(prefix))
    return out


def trace_failures(trace: DataFrame, event_names: DataFrame) -> DataFrame:
    """Traced calls that ended in an error or abort, with the event's name."""
    bad = trace.filter(F.col("error").isin(1, 2))
    return bad.join(event_names, "event_class", "left").withColumn("outcome", decode("error", {0: "Ok", 1: "Error", 2: "Abort"}))


def top_statements(trace: DataFrame, by: str, k: int, classes: Sequence[int] = (41, 45)) -> DataFrame:
    """Statements with the largest total of ``by``: sums and per-execution averages, ties kept."""
    from opskit.operators.aggregates import top_k_ties, weighted_avg

    d = trace.filter(F.col("event_class").isin(list(classes))).filter("statement is not null and statement <> ''")
    names = ["cpu", "reads", "writes", "duration"]
    sums = d.groupBy("statement").agg(
        F.sum("executions").alias("executions"), *[F.sum(n).alias(n) for n in names],
        *[weighted_avg(n, "executions").alias(f"avg_{n}") for n in names],
    )
    return top_k_ties(sums, [by], k)
