"""Sessions, blocking and statements."""

from pyspark.sql import functions as F

from opskit.operators import events as ev
from opskit.operators import sessions as ss
from opskit.plans import bindings as b
from opskit.plans.registry import report, stamp
from opskit.plans.reports_reshape import TREE

E = F.expr


@report("I18_active_counts", f"SELECT {stamp('collection_time')} AS collection_time, count(*) AS sessions FROM {b.SESSIONS} GROUP BY 1")
def _(db):
    return ss.active_counts(b.sessions(db))


@report("I19_blocking_tree", f"""
WITH {TREE} SELECT {stamp("TIMESTAMP '2024-01-01' + to_minutes(t.snapshot)")} AS collection_time, t.node AS session_id, t.parent AS blocking_session_id, t.head, t.depth::BIGINT AS depth, t.path, false AS cycle,
 '    ' || repeat('|         ', t.depth) || CASE WHEN t.depth = 0 THEN 'HEAD -  ' ELSE '|------  ' END || t.node || ' ' || s.sql_command AS blocking_tree,
 CASE WHEN t.parent IS NOT NULL THEN 'LCK_M_S' END AS lock_type, CASE WHEN t.parent IS NOT NULL THEN s.wait_ms // 1000 END AS lock_seconds
FROM t JOIN {b.SESSIONS} s ON s.snapshot = t.snapshot AND s.session_id = t.node""")
def _(db):
    return ss.blocking_tree(b.sessions(db))


@report("I20_blocked_over", f"""
WITH s AS {b.SESSIONS}, v AS (SELECT * FROM s WHERE blocking_session_id IS NOT NULL AND wait_ms >= 60000)
SELECT {stamp('collection_time')} AS collection_time, session_id, blocking_session_id, wait_ms // 60000 AS waiting_minutes FROM v
UNION ALL SELECT {stamp('s.collection_time')}, session_id, blocking_session_id, NULL FROM s WHERE EXISTS (SELECT 1 FROM v WHERE v.collection_time = s.collection_time AND v.blocking_session_id = s.session_id)""")
def _(db):
    return ss.blocked_over(b.sessions(db), 60000)


@report("I21_consistent_blocking", f"""
WITH s AS (SELECT * FROM {b.SESSIONS} WHERE collection_time <= TIMESTAMP '2024-01-01 01:30:00'), t AS (SELECT max(collection_time) AS t1 FROM s),
 u AS (SELECT max(collection_time) AS t2 FROM s, t WHERE collection_time < t1 AND date_diff('minute', collection_time, t1) >= 5)
SELECT {stamp('collection_time')} AS collection_time, session_id, blocking_session_id, minutes FROM s, t WHERE collection_time = t1 AND blocking_session_id IS NOT NULL AND minutes >= 5
 AND (session_id, blocking_session_id) IN (SELECT session_id, blocking_session_id FROM s, u WHERE collection_time = t2)""")
def _(db):
    return ss.consistent_blocking(b.sessions(db), 5, b.lit_ts("2024-01-01 01:30:00")).select("collection_time", "session_id", "blocking_session_id", "minutes")


@report("I22_job_blockers", f"""
WITH RECURSIVE s AS (SELECT *, program_name || '/' || (session_id % 3) AS prog FROM {b.SESSIONS} WHERE collection_time BETWEEN TIMESTAMP '2024-01-01 00:10:00' AND TIMESTAMP '2024-01-01 01:20:00'),
 j AS (SELECT collection_time, session_id FROM s WHERE prog = 'app1/2' UNION SELECT s.collection_time, s.blocking_session_id FROM j JOIN s ON s.collection_time = j.collection_time AND s.session_id = j.session_id WHERE s.blocking_session_id IS NOT NULL)
SELECT {stamp('collection_time')} AS collection_time, session_id FROM j""")
def _(db):
    s = b.sessions(db).withColumn("program_name", E("concat(program_name, '/', session_id % 3)"))
    return ss.job_blockers(s, "app1/2", b.lit_ts("2024-01-01 00:10:00"), b.lit_ts("2024-01-01 01:20:00"))


@report("I23_execution_spans", f"""
SELECT session_id, program_name, login_name, {stamp('min(collection_time)')} AS started, {stamp('max(collection_time)')} AS finished, count(*) AS seen,
 date_diff('minute', min(collection_time), max(collection_time)) AS minutes FROM {b.SESSIONS} GROUP BY 1, 2, 3""")
def _(db):
    return ss.execution_spans(b.sessions(db), ["session_id", "program_name", "login_name"])


@report("I24_longest_transaction", f"""
SELECT login_name, program_name, session_id, snapshot, m AS tran_minutes FROM (SELECT *, row_number() OVER (PARTITION BY login_name, program_name ORDER BY m DESC, snapshot, session_id) AS rn
 FROM (SELECT *, date_diff('minute', tran_start_time, collection_time) AS m FROM {b.SESSIONS}) WHERE open_tran_count > 0 AND m > 180) WHERE rn = 1""")
def _(db):
    d = ss.longest_tran(b.sessions(db), ["login_name", "program_name"], 180, ["snapshot", "session_id"])
    return d.select("login_name", "program_name", "session_id", "snapshot", "tran_minutes")


@report("I25_persistent_sessions", f"""
SELECT login_name, count(*) AS seen FROM {b.SESSIONS} GROUP BY 1 HAVING count(*) > (SELECT count(DISTINCT collection_time) FROM {b.SESSIONS})""")
def _(db):
    return ss.persistent_sessions(b.sessions(db), ["login_name"])


@report("I29_program_load", """
WITH r AS (SELECT o_orderkey AS request_id, o_orderpriority AS pool, 'app' || (o_custkey % 20) AS program_name FROM orders), t AS (SELECT l_orderkey AS request_id, l_suppkey % 64 AS s FROM lineitem),
 a AS (SELECT pool, program_name, count(*) AS active_requests, sum(coalesce(n, 0))::BIGINT AS num_tasks FROM r LEFT JOIN (SELECT request_id, count(*) AS n FROM t GROUP BY 1) USING (request_id) GROUP BY 1, 2),
 u AS (SELECT pool, program_name, count(DISTINCT s) AS num_schedulers FROM r JOIN t USING (request_id) GROUP BY 1, 2)
SELECT pool, program_name, active_requests, num_tasks, num_schedulers, floor(num_schedulers * 100.0 / 80)::BIGINT AS scheduler_percent FROM a JOIN u USING (pool, program_name)""")
def _(db):
    r = db.orders.select(F.col("o_orderkey").alias("request_id"), F.col("o_orderpriority").alias("pool"), F.concat(F.lit("app"), F.col("o_custkey") % 20).alias("program_name"))
    t = db.lineitem.select(F.col("l_orderkey").alias("request_id"), (F.col("l_suppkey") % 64).alias("scheduler_id"))
    return ss.program_load(r, t, 80)


@report("I30_top_statements", """
WITH g AS (SELECT 'stmt' || (l_partkey % 500) AS statement, sum(l_linenumber)::BIGINT AS executions, sum(l_quantity)::BIGINT AS cpu, sum(floor(l_extendedprice))::BIGINT AS reads, sum(l_suppkey)::BIGINT AS writes, sum(l_orderkey)::BIGINT AS duration
 FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1)
SELECT statement, executions, cpu, reads, writes, duration, round(cpu / executions + 1e-9, 2) AS avg_cpu, round(reads / executions + 1e-9, 2) AS avg_reads, round(writes / executions + 1e-9, 2) AS avg_writes, round(duration / executions + 1e-9, 2) AS avg_duration
FROM (SELECT *, rank() OVER (ORDER BY reads DESC) AS r FROM g) WHERE r <= 15""")
def _(db):
    trace = db.lineitem.select(
        F.concat(F.lit("stmt"), F.col("l_partkey") % 500).alias("statement"), F.col("l_linenumber").cast("bigint").alias("executions"), F.col("l_quantity").cast("bigint").alias("cpu"),
        F.floor("l_extendedprice").alias("reads"), F.col("l_suppkey").alias("writes"), F.col("l_orderkey").alias("duration"),
        E("CASE l_returnflag WHEN 'A' THEN 41 WHEN 'R' THEN 45 ELSE 10 END").alias("event_class"))
    return ev.top_statements(trace, "reads", 15)


@report("I67_blocked_count", f"""
WITH RECURSIVE e AS (SELECT collection_time, session_id, blocking_session_id FROM {b.SESSIONS}), t AS (
 SELECT collection_time, session_id AS top, session_id FROM e UNION ALL SELECT e.collection_time, t.top, e.session_id FROM t JOIN e ON e.collection_time = t.collection_time AND e.blocking_session_id = t.session_id)
SELECT {stamp('collection_time')} AS collection_time, top AS session_id, count(*) - 1 AS blocked_session_count FROM t GROUP BY 1, 2 HAVING count(*) > 1""")
def _(db):
    return ss.blocked_count(b.sessions(db))


@report("I68_indirect_use", f"""
SELECT snapshot, session_id FROM {b.SESSIONS} WHERE database_name <> 'db1' AND session_id % 2 = 0""")
def _(db):
    locks = E("concat('<locks><Database name=\"', CASE WHEN session_id % 2 = 0 THEN 'db1' ELSE 'db9' END, '\"/></locks>')")
    return ss.indirect_use(b.sessions(db).withColumn("locks", locks), "db1").select("snapshot", "session_id")


@report("I69_running_jobs", f"""
WITH a AS (SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus, o_orderkey % 5 AS sess, o_orderkey % 3 AS last FROM orders), n AS (SELECT c_custkey, c_name, c_nationkey FROM customer)
SELECT o_orderkey, 'job' || o_custkey AS job_name, last + 1 AS step_id, 'step' || (last + 1) AS step_name,
 printf('%02d %02d:%02d:%02d', s // 86400, s // 3600 % 24, s // 60 % 60, s % 60) AS elapsed, date_diff('minute', TIMESTAMP '2001-09-01', TIMESTAMP '2001-09-01' + to_hours(c_nationkey)) AS minutes_to_next
FROM (SELECT *, date_diff('second', o_orderdate, TIMESTAMP '2001-09-01') AS s FROM a WHERE sess = 4 AND o_orderstatus = 'P') JOIN n ON c_custkey = o_custkey""")
def _(db):
    act = db.orders.select(
        "o_orderkey", F.concat(F.lit("job"), "o_custkey").alias("job_name"), (F.col("o_orderkey") % 5).alias("scheduler_session"), F.col("o_orderdate").alias("start_time"),
        E("CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END").alias("stop_time"), E("nullif(o_orderkey % 3, 0)").alias("last_step_id"))
    jobs = db.customer.select(F.concat(F.lit("job"), "c_custkey").alias("job_name"), "c_nationkey")
    steps = jobs.select("job_name", F.explode(E("sequence(1L, 3L)")).alias("step_id")).withColumn("step_name", F.concat(F.lit("step"), "step_id"))
    now = b.lit_ts("2001-09-01 00:00:00")
    nxt = jobs.select("job_name", (now + F.make_dt_interval(hours=F.col("c_nationkey"))).alias("next_run_time"))
    return ss.running_jobs(act, steps, nxt, now).select("o_orderkey", "job_name", "step_id", "step_name", "elapsed", "minutes_to_next")
