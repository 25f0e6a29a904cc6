"""Event documents derived from the given tables."""

from pyspark.sql import functions as F

from opskit.operators import events as ev
from opskit.plans import bindings as b
from opskit.plans.registry import report, stamp
from opskit.session import spread

E = F.expr
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def item(name, value, tag="data", text=None):
    body = [F.lit(f'<{tag} name="{name}"><value>'), value.cast("string"), F.lit("</value>")]
    if text is not None:
        body += [F.lit("<text>"), text, F.lit("</text>")]
    return F.concat(*body, F.lit(f"</{tag}>"))


def document(name, ts, *items):
    return F.concat(F.lit('<event name="'), name, F.lit('" timestamp="'), F.date_format(ts, ISO), F.lit('">'), *items, F.lit("</event>"))


def event_xml(db):
    """One flat event document per event row.

    Building and parsing a document costs far more than moving the narrow row it is made
    of, so the rows are spread evenly first.
    """
    k, c = F.col("k"), F.col("c")
    numbers = {"k": E("cast(get_json_object(props, '$.k') as bigint)"), "c": E("cast(round(value * 100) as bigint)")}
    name = E("CASE event_type WHEN 'error' THEN 'error_reported' WHEN 'signup' THEN 'availability_replica_state_change' ELSE 'sql_batch_completed' END")
    items = [
        item("cpu_time", c * 1000), item("duration", c * 10000), item("logical_reads", k), item("writes", F.col("event_id") % 50), item("row_count", k * 3),
        item("statement", F.concat(F.lit("select "), k, F.lit(" &lt; 7"))), item("result", k % 3, text=E("CASE WHEN k % 3 = 2 THEN 'Abort' ELSE 'Ok' END")),
        item("error_number", k + 1200), item("severity", k % 25), item("state", k % 4), item("message", F.concat(F.lit("failed for user "), "user_id")),
        item("availability_group_name", F.concat(F.lit("ag"), F.col("user_id") % 4)), item("previous_state", k % 2, text=F.lit("RESOLVING")), item("current_state", k % 3, text=F.concat(F.lit("STATE"), k % 3)),
        item("client_app_name", F.concat(F.lit("app"), F.col("user_id") % 6), "action"), item("session_id", F.col("user_id") + 51, "action"), item("database_name", F.concat(F.lit("db"), F.col("user_id") % 3), "action"),
    ]
    return spread(db.events.withColumns(numbers), "event_id").select("event_id", document(name, "ts", *items).alias("xml"))


EV = """(SELECT *, (props->>'$.k')::BIGINT AS k, cast(round(value * 100) AS BIGINT) AS c, 'app' || (user_id % 6) AS client_app_name FROM events)"""


@report("I31_events_slow", f"""
SELECT event_id, {stamp('ts')} AS time, c * 10000 / 1000000.0::DOUBLE AS duration, k AS logical_reads, event_id % 50 AS writes, k * 3 AS row_count, 'select ' || k || ' < 7' AS statement, client_app_name, user_id + 51 AS session_id, 'db' || (user_id % 3) AS database_name
FROM {EV} WHERE event_type NOT IN ('error', 'signup') AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25' AND client_app_name <> 'app3'""")
def _(db):
    d = ev.events_slow(event_xml(db), "xml", b.lit_ts("2024-01-05"), b.lit_ts("2024-01-25"), exclude_app="app3", names=["sql_batch_completed"])
    return d.drop("event_name", "cpu_time")


@report("I31_events_timeout", f"""
SELECT event_id, {stamp('ts')} AS time, c / 100.0::DOUBLE AS duration, 'Abort' AS result_text, 'select ' || k || ' < 7' AS statement, client_app_name FROM {EV} WHERE k % 3 = 2""")
def _(db):
    return ev.events_timeout(event_xml(db), "xml")


@report("I31_events_error", f"""
SELECT event_id, {stamp('ts')} AS time, k + 1200 AS error_number, k % 25 AS severity, k % 4 AS state, 'failed for user ' || user_id AS message, client_app_name, 'db' || (user_id % 3) AS database_name
FROM {EV} WHERE event_type = 'error' AND k + 1200 NOT IN (1205, 1222) AND contains('failed for user ' || user_id, 'user 1')""")
def _(db):
    return ev.events_error(event_xml(db), "xml", not_numbers="1205, 1222", message="user 1")


def process_xml(role, spid, wait):
    return F.concat(
        F.lit(f"<{role}><process id=\"p"), spid, F.lit('" spid="'), spid, F.lit('" status="suspended" waitresource="KEY: '), spid, F.lit('" waittime="'), wait,
        F.lit('" lockMode="S" clientapp="app" hostname="h" loginname="'), F.col("login_name"), F.lit('" isolationlevel="rc" currentdb="5"><inputbuf>'), F.col("sql_command"),
        F.lit(f"</inputbuf></process></{role}>"))


def blocking_xml(db):
    """One blocked-process report per blocked session of a snapshot."""
    s = b.sessions(db).filter("blocking_session_id is not null")
    body = F.concat(F.lit('<data name="blocked_process"><value><blocked-process-report>'), process_xml("blocked-process", F.col("session_id"), F.col("wait_ms")),
                    process_xml("blocking-process", F.col("blocking_session_id"), F.lit(0)), F.lit("</blocked-process-report></value></data>"))
    return s.select(document(F.lit("blocked_process_report"), "collection_time", item("duration", F.col("wait_ms") * 1000), body).alias("xml"))


@report("I32_events_blocking", f"""
WITH s AS (SELECT * FROM {b.SESSIONS} WHERE blocking_session_id IS NOT NULL), r AS (
 SELECT collection_time AS t, session_id AS spid, wait_ms / 1000.0::DOUBLE AS d, 1 AS blocked, blocking_session_id AS by_spid, wait_ms AS wait, login_name, sql_command FROM s
 UNION ALL SELECT collection_time, blocking_session_id, NULL, 0, NULL, 0, login_name, sql_command FROM s),
 g AS (SELECT t, spid, round(max(d), 2) AS block_duration, max(blocked)::BIGINT AS is_blocked, max(by_spid) AS blocking_spid, max(wait) AS wait_time, max(login_name) AS login_name, max(sql_command) AS input_buffer FROM r GROUP BY 1, 2)
SELECT rank() OVER (ORDER BY t) AS block_group, {stamp('t')} AS time, spid, block_duration, is_blocked, blocking_spid, wait_time, login_name, input_buffer FROM g""")
def _(db):
    d = ev.events_blocking(blocking_xml(db), "xml")
    return d.select("block_group", "time", "spid", "block_duration", "is_blocked", "blocking_spid", "wait_time", "login_name", "input_buffer")


def deadlock_xml(db):
    """One deadlock document per four neighbouring turns: each turn owns a key the next one waits for."""
    t = db.conversations.withColumn("grp", (F.col("turn") / 4).cast("int")).withColumn("n", F.col("turn") % 4)
    proc = F.concat(F.lit('<process id="p'), "turn", F.lit('" spid="'), F.col("turn") + 51, F.lit('" status="'), "role", F.lit('" lockMode="X" loginname="'), "role", F.lit('"><inputbuf>q</inputbuf></process>'))
    key = F.concat(F.lit('<keylock hobtid="'), F.col("turn") + 1000, F.lit('" objectname="db.tbl'), F.col("turn") % 2, F.lit('" indexname="ix" mode="X" id="lock'), "turn",
                   F.lit('"><owner-list><owner id="p'), "turn", F.lit('" mode="X"/></owner-list><waiter-list><waiter id="p'), F.col("turn") + 1, F.lit('" mode="S" requestType="wait"/></waiter-list></keylock>'))
    g = t.groupBy("conv_id", "grp").agg(
        F.array_join(F.collect_list(proc), "").alias("procs"), F.array_join(F.collect_list(key), "").alias("keys"), F.min("turn").alias("first"), F.max("turn").alias("last"))
    body = F.concat(F.lit('<data name="xml_report"><value><deadlock><victim-list><victimProcess id="p'), "first", F.lit('"/><victimProcess id="p'), "last",
                    F.lit('"/></victim-list><process-list>'), "procs", F.lit("</process-list><resource-list>"), "keys", F.lit("</resource-list></deadlock></value></data>"))
    at = b.minutes_after("2024-01-01 00:00:00", F.col("conv_id"))
    return g.select("conv_id", F.col("grp").cast("bigint").alias("grp"), document(F.lit("xml_deadlock_report"), at, body).alias("xml"))


@report("I33_events_deadlock", f"""
WITH t AS (SELECT *, turn // 4 AS grp, min(turn) OVER (PARTITION BY conv_id, turn // 4) AS a, max(turn) OVER (PARTITION BY conv_id, turn // 4) AS z, count(*) OVER (PARTITION BY conv_id, turn // 4) AS n FROM conversations),
 o AS (SELECT l.conv_id, l.grp, l.turn AS lk, p.turn AS pt, p.role, l.n, CASE WHEN p.turn = l.turn THEN 'X' ELSE 'S' END AS request_mode, CASE WHEN p.turn > l.turn THEN 'wait' END AS request_type, p.turn IN (p.a, p.z) AS victim
 FROM t l JOIN t p ON p.conv_id = l.conv_id AND p.grp = l.grp AND (p.turn = l.turn OR p.turn = l.turn + 1))
SELECT conv_id, grp, {stamp("TIMESTAMP '2024-01-01' + to_minutes(conv_id)")} AS time, 'keylock' AS lock_kind, 'db.tbl' || (lk % 2) AS object_name, 'p' || pt AS process_id, victim, 'X' AS owner_mode, request_mode, request_type, role AS status,
 CASE WHEN n > 1 THEN 'db.tbl0, db.tbl1' ELSE 'db.tbl0' END AS objects FROM o""")
def _(db):
    d = ev.events_deadlock(deadlock_xml(db), "xml")
    return d.select("conv_id", "grp", "time", "lock_kind", "object_name", "process_id", "victim", "owner_mode", "request_mode", "request_type", "status", "objects")


@report("I34_role_switches", f"""
SELECT event_id, {stamp("ts + INTERVAL 5 HOUR")} AS time, 'ag' || (user_id % 4) AS group_name, 'RESOLVING' AS previous_state, 'STATE' || (k % 3) AS current_state FROM {EV} WHERE event_type = 'signup'""")
def _(db):
    return ev.role_switches(event_xml(db), "xml", 5)


@report("I64_plans_with", """
SELECT p_partkey, round((p_size + 1)::DOUBLE / greatest(date_diff('hour', TIMESTAMP '2024-01-01' + to_hours(p_partkey % 48), TIMESTAMP '2024-01-03'), 1) + 1e-9, 2) AS executions_per_hour,
 (p_retailprice::BIGINT // (p_size + 1))::BIGINT AS cpu_per_execution FROM part WHERE p_size % 2 = 0 AND p_type = 'PROMO'""")
def _(db):
    plan = E("concat('<ShowPlan><Stmt>', CASE WHEN p_size % 2 = 0 THEN '<Warnings/>' ELSE '' END, '<ColumnReference Database=\"', p_type, '\"/></Stmt></ShowPlan>')")
    d = db.part.withColumns({"plan": plan, "n": F.col("p_size") + 1, "cpu": F.round("p_retailprice").cast("bigint"),
                             "created": b.lit_ts("2024-01-01 00:00:00") + F.make_dt_interval(hours=(F.col("p_partkey") % 48).cast("int"))})
    out = ev.plans_with(d, "plan", ["//Warnings", "//ColumnReference[@Database=\"PROMO\"]"], b.lit_ts("2024-01-03 00:00:00"), "n", {"cpu": "cpu"}, "created")
    return out.select("p_partkey", "executions_per_hour", "cpu_per_execution")


@report("I72_event_rules", """
SELECT doc_id FROM documents WHERE ((source LIKE 'src1%' AND lower(rtrim(text)) LIKE '%the%') OR (source = 'src7' AND lang = 'en')) AND NOT starts_with(text, 'T') AND NOT starts_with(text, 'A')""")
def _(db):
    rules = [{"source": "src1%", "text": "%the%"}, {"source": "src7", "lang": "en"}]
    return ev.event_rules(db.documents, rules, {"text": ["T", "A"]}).select("doc_id")


@report("I74_trace_failures", """
SELECT l_orderkey, l_partkey, l_linenumber::BIGINT AS l_linenumber, p_brand AS event_name, CASE l_partkey % 4 WHEN 1 THEN 'Error' WHEN 2 THEN 'Abort' END AS outcome FROM lineitem LEFT JOIN part ON p_partkey = l_suppkey WHERE l_partkey % 4 IN (1, 2)""")
def _(db):
    trace = db.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", F.col("l_suppkey").alias("event_class"), (F.col("l_partkey") % 4).alias("error"))
    names = db.part.select(F.col("p_partkey").alias("event_class"), F.col("p_brand").alias("event_name"))
    return ev.trace_failures(trace, names).select("l_orderkey", "l_partkey", "l_linenumber", "event_name", "outcome")
