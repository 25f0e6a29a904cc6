"""Alerts, replication latency and limits."""

from pyspark.sql import functions as F

from opskit.operators import alerts as al
from opskit.plans import bindings as b
from opskit.plans.registry import report, stamp

E = F.expr


def inline_rows(db, rows, names):
    """A constant rule table."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rows]
    return db.spark.range(1).select(F.inline(F.array(*structs)))


CHECKS = [("click", ">9", ">15"), ("error", "<5", "<2"), ("purchase", "<>7", ">=20"), ("view", "=3", "<=0.5")]
CHECK_SQL = "(VALUES " + ", ".join(str(c) for c in CHECKS) + ") c(event_type, warning, critical)"


def _hit(rule):
    op, lim = f"regexp_extract({rule}, '^(<>|<=|>=|<|>|=)', 1)", f"regexp_extract({rule}, '([0-9.]+)$', 1)::DOUBLE"
    return f"CASE {op} WHEN '<>' THEN v <> {lim} WHEN '<=' THEN v <= {lim} WHEN '>=' THEN v >= {lim} WHEN '<' THEN v < {lim} WHEN '>' THEN v > {lim} ELSE v = {lim} END"


STATUS = f"""(SELECT event_id, event_type, ts, v, CASE WHEN v IS NULL THEN 'CHECK ERROR' WHEN {_hit('critical')} THEN 'CRITICAL' WHEN {_hit('warning')} THEN 'WARNING' ELSE 'OK' END AS check_status
 FROM (SELECT *, CASE WHEN event_id % 97 <> 0 THEN value END AS v FROM events) JOIN {CHECK_SQL} USING (event_type))"""


def check_log(db):
    v = db.events.withColumn("v", E("CASE WHEN event_id % 97 <> 0 THEN value END"))
    return al.check_status(v, inline_rows(db, CHECKS, ["event_type", "warning", "critical"]), "event_type", "v")


@report("I35_check_status", f"SELECT event_id, check_status FROM {STATUS}")
def _(db):
    return check_log(db).select("event_id", "check_status")


@report("I36_flapping", f"""
WITH l AS (SELECT *, CASE WHEN check_status IS DISTINCT FROM lag(check_status) OVER (PARTITION BY event_type ORDER BY ts, event_id) THEN 1 ELSE 0 END AS ch FROM {STATUS}),
 r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM l WHERE ts > TIMESTAMP '2024-01-15 06:00:00' AND ts <= TIMESTAMP '2024-01-15 12:00:00')
SELECT event_type, count(*) AS checks, sum(ch) / count(*) AS change_ratio, sum(ch) / count(*) BETWEEN 0.35 AND 0.65 AS is_flapping FROM r WHERE rn <= 12 GROUP BY 1""")
def _(db):
    log = al.status_changes(check_log(db), "event_type", "ts", "check_status", ["event_id"])
    return al.flapping(log, "event_type", "ts", b.lit_ts("2024-01-15 12:00:00"), tie=["event_id"])


@report("I37_due_checks", """
SELECT c_custkey AS check_id, c_nationkey::BIGINT AS frequency_minutes FROM customer LEFT JOIN (SELECT user_id, max(ts) AS last FROM events GROUP BY 1) ON user_id = c_custkey
WHERE c_acctbal >= 0 AND date_diff('minute', coalesce(last, TIMESTAMP '1970-01-01'), TIMESTAMP '2024-01-31') >= coalesce(c_nationkey * 60, 0)""")
def _(db):
    cfg = db.customer.select(F.col("c_custkey").alias("check_id"), (F.col("c_nationkey") * 60).alias("frequency_minutes"), (F.col("c_acctbal") >= 0).alias("enabled"))
    meta = db.events.groupBy(F.col("user_id").alias("check_id")).agg(F.max("ts").alias("last_check"))
    return al.due_checks(cfg, meta, "check_id", b.lit_ts("2024-01-31")).select("check_id", (F.col("frequency_minutes") / 60).cast("bigint").alias("frequency_minutes"))


H0 = f"(SELECT *, row_number() OVER (PARTITION BY job_name ORDER BY instance_id DESC) AS rn FROM {b.JOB_HISTORY} WHERE step_id = 0)"


@report("I38_consecutive_failures", f"""
SELECT job_name, coalesce(min(CASE WHEN run_status = 1 THEN rn END) - 1, count(*)) AS failures, coalesce(min(CASE WHEN run_status = 1 THEN rn END) - 1, 0) AS failures_compat FROM {H0} WHERE rn <= 20 GROUP BY 1""")
def _(db):
    h = b.job_history(db).filter("step_id = 0")
    a = al.consecutive_failures(h, "job_name", "instance_id", "run_status")
    c = al.consecutive_failures(h, "job_name", "instance_id", "run_status", compat=True).withColumnRenamed("failures", "failures_compat")
    return a.join(c, "job_name")


@report("I39_alerts_due", f"""
SELECT job_name, count(*) AS failed FROM {H0} WHERE rn <= 2 AND run_status = 0 AND instance_id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 48) GROUP BY 1 HAVING count(*) >= 2""")
def _(db):
    suppress = db.lineitem.filter("l_quantity > 48").select(F.col("l_orderkey").alias("instance_id"))
    return al.alerts_due(b.job_history(db).filter("step_id = 0"), suppress, "job_name", "instance_id", "run_status", 2)


@report("I40_stale", f"""
SELECT user_id, event_type, {stamp('max(ts)')} AS last_update FROM events GROUP BY 1, 2 HAVING max(ts) < TIMESTAMP '2024-01-31' - INTERVAL 2880 MINUTE""")
def _(db):
    return al.stale(db.events, ["user_id", "event_type"], "ts", 2880, b.lit_ts("2024-01-31"))


@report("I41_last_progress", f"""
WITH h AS (SELECT user_id, ts, CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 3 ELSE 2 END AS st FROM events),
 s AS (SELECT user_id, coalesce(max(CASE WHEN st = 1 THEN ts END), TIMESTAMP '2024-01-29') AS start_time FROM h GROUP BY 1)
SELECT s.user_id, {stamp('start_time')} AS start_time, {stamp('coalesce(max(CASE WHEN st = 3 AND ts >= start_time THEN ts END), start_time)')} AS last_log FROM s JOIN h USING (user_id) GROUP BY 1, start_time""")
def _(db):
    h = db.events.select("user_id", "ts", E("CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 3 ELSE 2 END").alias("st"))
    return al.last_progress(h, "user_id", "ts", "st", b.lit_ts("2024-01-31"))


TL = f"""(SELECT h.id, h.publication, h.publisher_commit, a.subscriber, a.l_partkey, distributor_commit, subscriber_commit, date_diff('minute', publisher_commit, distributor_commit) AS distributor_latency,
 date_diff('minute', distributor_commit, subscriber_commit) AS subscriber_latency, date_diff('minute', publisher_commit, subscriber_commit) AS overall_latency
 FROM {b.TOKEN_HEADER} h JOIN {b.TOKEN_HISTORY} a ON a.id = h.id)"""


@report("I42_token_latency", f"SELECT id, publication, subscriber, l_partkey, distributor_latency, subscriber_latency, overall_latency FROM {TL}")
def _(db):
    return al.token_latency(b.token_header(db), b.token_history(db), "id").select(
        "id", "publication", "subscriber", "l_partkey", "distributor_latency", "subscriber_latency", "overall_latency")


@report("I43_close_lost", f"""
WITH h AS {b.TOKEN_HEADER}, m AS (SELECT publication, max(publisher_commit) AS newest FROM h WHERE is_processed GROUP BY 1)
SELECT id, is_processed OR coalesce(publisher_commit < newest, false) AS is_processed, NOT is_processed AND coalesce(publisher_commit < newest, false) AS lost FROM h LEFT JOIN m USING (publication)""")
def _(db):
    return al.close_lost(b.token_header(db)).select("id", "is_processed", "lost")


@report("I44_current_latency", f"""
WITH p AS (SELECT publication, arg_min(publisher_commit, id) AS pend FROM {b.TOKEN_HEADER} WHERE NOT is_processed GROUP BY 1),
 d AS (SELECT * FROM (SELECT publication, overall_latency, row_number() OVER (PARTITION BY publication ORDER BY publisher_commit DESC, subscriber_commit DESC, id DESC) AS rn FROM {TL}) WHERE rn = 1)
SELECT publication, CASE WHEN pend IS NOT NULL THEN 'Active' ELSE 'History' END AS token_state, CASE WHEN pend IS NOT NULL THEN date_diff('minute', pend, TIMESTAMP '2001-12-01') ELSE overall_latency END AS current_latency FROM p FULL JOIN d USING (publication)""")
def _(db):
    h = b.token_header(db)
    done = al.token_latency(h, b.token_history(db), "id")
    return al.current_latency(h, done, b.lit_ts("2001-12-01 00:00:00"))


@report("I45_token_rate", f"""
SELECT h.id, h.publication, {stamp('subscriber_commit')} AS subscriber_commit FROM {b.TOKEN_HEADER} h LEFT JOIN {b.TOKEN_HISTORY} a ON a.id = h.id WHERE subscriber_commit IS NULL OR subscriber_commit >= TIMESTAMP '2001-10-20 22:00:00'""")
def _(db):
    return al.token_rate(b.token_header(db), b.token_history(db), "id", b.lit_ts("2001-10-21 00:00:00")).select("id", "publication", "subscriber_commit")


@report("I46_agent_errors", f"""
SELECT user_id, comments, {stamp('max(ts)')} AS time, max(error_id)::BIGINT AS error_id FROM (SELECT user_id, ts, CASE WHEN event_type = 'error' THEN (props->>'$.k')::INT ELSE 0 END AS error_id,
 CASE WHEN (props->>'$.k')::INT % 5 = 0 THEN 'Skipped ' || user_id || ' error(s) when applying transactions at the Subscriber.' ELSE 'code ' || ((props->>'$.k')::INT % 5) END AS comments FROM events)
WHERE error_id <> 0 AND ts >= TIMESTAMP '2024-01-10' AND NOT comments LIKE 'Skipped % error(s) when applying transactions at the Subscriber.' GROUP BY 1, 2""")
def _(db):
    k = E("cast(get_json_object(props, '$.k') as int)")
    d = db.events.select(
        "user_id", F.col("ts").alias("time"), F.when(F.col("event_type") == "error", k).otherwise(0).alias("error_id"),
        F.when(k % 5 == 0, F.concat(F.lit("Skipped "), "user_id", F.lit(" error(s) when applying transactions at the Subscriber."))).otherwise(F.concat(F.lit("code "), k % 5)).alias("comments"))
    return al.agent_errors(d, b.lit_ts("2024-01-10"), ["user_id"])


LIMITS = [("default", 3000), ("MACHINERY", 290), ("BUILDING", 330)]


@report("I62_limit_status", f"""
WITH c AS (SELECT c_mktsegment AS program_name, count(*) AS connections FROM customer GROUP BY 1 UNION ALL SELECT event_type, count(*) FROM events GROUP BY 1),
 l AS (SELECT * FROM (VALUES {", ".join(str(x) for x in LIMITS)}) v(program_name, lim)), j AS (SELECT c.*, coalesce(l.lim, 2000) AS lim FROM c LEFT JOIN (SELECT * FROM l) l USING (program_name))
SELECT program_name, connections, lim::BIGINT AS "limit", CASE WHEN connections >= lim THEN 'BLOCK' WHEN connections >= lim * 0.8 THEN 'WARN' END AS action FROM j WHERE connections >= lim * 0.8""".replace("coalesce(l.lim, 2000)", "coalesce(l.lim, (SELECT lim FROM l WHERE program_name = 'default'))"))
def _(db):
    s = db.customer.select(F.col("c_mktsegment").alias("program_name")).unionByName(db.events.select(F.col("event_type").alias("program_name")))
    return al.limit_status(s, inline_rows(db, LIMITS, ["program_name", "limit"]))


@report("I70_stuck_workflows", """
WITH s AS (SELECT conv_id AS setup_id, CASE WHEN turn = 0 THEN 'main' ELSE 'step' || turn END AS job_name, CASE (length(text) + turn) % 3 WHEN 0 THEN 'ResourceWait' WHEN 1 THEN 'Completed' ELSE 'Executing' END AS current_state,
 CASE WHEN length(text) % 2 = 0 THEN 'Unknown error (0xffffffff)' ELSE 'fine' END AS description FROM conversations)
SELECT s.setup_id, s.job_name, j.current_state AS main_state FROM s JOIN s j ON j.setup_id = s.setup_id AND j.job_name = 'main' WHERE s.job_name <> 'main'
 AND (j.current_state = 'ResourceWait' OR (j.current_state = 'Completed' AND j.description = 'Unknown error (0xffffffff)' AND s.current_state = 'Executing'))""")
def _(db):
    e = db.conversations.select(
        F.col("conv_id").alias("setup_id"), E("CASE WHEN turn = 0 THEN 'main' ELSE concat('step', turn) END").alias("job_name"),
        E("CASE (length(text) + turn) % 3 WHEN 0 THEN 'ResourceWait' WHEN 1 THEN 'Completed' ELSE 'Executing' END").alias("current_state"),
        E("CASE WHEN length(text) % 2 = 0 THEN 'Unknown error (0xffffffff)' ELSE 'fine' END").alias("description"))
    return al.stuck_workflows(e).select("setup_id", "job_name", "main_state")


@report("I73_alert_rows", f"""
SELECT file_id, 'volume' AS kind FROM {b.FILES} WHERE file_id % 100 > 80 UNION ALL SELECT file_id, 'backup' FROM {b.FILES} WHERE file_id % 4 = 0 UNION ALL SELECT file_id, 'replica' FROM {b.FILES} WHERE file_id % 5 = 0 OR file_id % 7 = 0""")
def _(db):
    d = b.files(db).select("file_id", (F.col("file_id") % 100).alias("used_percent"), E("if(file_id % 4 = 0, 'No', 'Yes')").alias("full_backup_24h"),
                           E("if(file_id % 5 = 0, 'BAD', 'HEALTHY')").alias("health"), E("if(file_id % 7 = 0, 'Lost', 'Connected')").alias("connection"))
    rows = [al.alert_rows(k, d).select("file_id", F.lit(k).alias("kind")) for k in ("volume", "backup", "replica")]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@report("I75_breach_count", "SELECT count(*) FILTER (c >= 90) AS breaches, count(*) FILTER (c >= 90) >= 5 AS act FROM (SELECT user_id, count(*) AS c FROM events GROUP BY 1)")
def _(db):
    return al.breach_count(db.events.groupBy("user_id").agg(F.count("*").alias("c")), "c", 90, 5)
