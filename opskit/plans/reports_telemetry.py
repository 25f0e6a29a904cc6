"""Counters, waits, files and roll-ups."""

from pyspark.sql import functions as F

from opskit.functions import clock
from opskit.operators import rollup as ro
from opskit.operators import telemetry as tm
from opskit.plans import bindings as b
from opskit.plans.registry import report, stamp
from opskit.session import durable

E = F.expr
LAG = "OVER (PARTITION BY {k} ORDER BY collection_time, event_id)"


def lagged(keys):
    w = LAG.format(k=keys)
    return f"(SELECT *, lag(cntr_value) {w} AS pv, lag(collection_time) {w} AS pt FROM {b.COUNTERS})"


@report("I01_counter_delta", f"""
SELECT event_id, cntr_value - pv AS delta, date_diff('second', pt, collection_time) AS elapsed_seconds,
 (cntr_value - pv)::DOUBLE / date_diff('second', pt, collection_time) AS per_second
FROM {lagged('server_id, counter_name')} WHERE date_diff('minute', pt, collection_time) BETWEEN 1 AND 60""")
def _(db):
    d = tm.counter_delta(b.counters(db), ["server_id", "counter_name"], "collection_time", ["cntr_value"], ["event_id"])
    return d.select("event_id", F.col("cntr_value_delta").alias("delta"), "elapsed_seconds", tm.per_second("cntr_value_delta").alias("per_second"))


@report("I02_delta_drop_resets", f"""
SELECT event_id, cntr_value - pv AS delta FROM {lagged('server_id, counter_name')} WHERE date_diff('minute', pt, collection_time) BETWEEN 1 AND 60 AND cntr_value >= pv""")
def _(db):
    d = tm.counter_delta(b.counters(db), ["server_id", "counter_name"], "collection_time", ["cntr_value"], ["event_id"], on_reset="drop")
    return d.select("event_id", F.col("cntr_value_delta").alias("delta"))


@report("I03_delta_restart", f"""
SELECT event_id, CASE WHEN pv IS NULL THEN 0 WHEN cntr_value < pv THEN cntr_value ELSE cntr_value - pv END AS delta,
 date_diff('second', pt, collection_time) AS interval_seconds FROM {lagged('server_id, counter_name')}""")
def _(db):
    d = tm.counter_delta(b.counters(db), ["server_id", "counter_name"], "collection_time", ["cntr_value"], ["event_id"], on_reset="restart")
    return d.select("event_id", F.col("cntr_value_delta").alias("delta"), F.col("elapsed_seconds").alias("interval_seconds"))


def file_stats(db):
    """Daily file statistics per (server, file)."""
    k = E("cast(get_json_object(props, '$.k') as bigint)")
    c = E("cast(round(value * 100) as bigint)")
    d = db.events.withColumn("k", k).withColumn("c", c)
    return d.groupBy((F.col("user_id") % 10).alias("server_id"), F.col("event_type").alias("file"), F.date_trunc("day", "ts").cast("timestamp_ntz").alias("check_date")).agg(
        F.count("*").alias("size_mb"), F.sum("c").alias("io_stall_read_ms"), F.sum("k").alias("num_of_reads"), E("sum(c * 1024)").alias("bytes_read"),
        E("sum(event_id % 1000)").alias("io_stall_write_ms"), E("sum(event_id % 100)").alias("num_of_writes"), E("sum(event_id * 64)").alias("bytes_written"))


FILE_STATS = """(SELECT user_id % 10 AS server_id, event_type AS file, date_trunc('day', ts)::TIMESTAMP AS check_date, count(*) AS size_mb,
 sum(c)::BIGINT AS io_stall_read_ms, sum(k)::BIGINT AS num_of_reads, sum(c * 1024)::BIGINT AS bytes_read, sum(event_id % 1000)::BIGINT AS io_stall_write_ms,
 sum(event_id % 100)::BIGINT AS num_of_writes, sum(event_id * 64)::BIGINT AS bytes_written
 FROM (SELECT *, cast(round(value * 100) AS BIGINT) AS c, (props->>'$.k')::BIGINT AS k FROM events) GROUP BY 1, 2, 3)"""
FILE_CHANGE = """size_mb - p.size_mb AS size_mb_growth, io_stall_read_ms - p.io_stall_read_ms AS read_stall_ms,
 CASE WHEN num_of_reads = p.num_of_reads THEN 0 ELSE trunc((io_stall_read_ms - p.io_stall_read_ms) / (num_of_reads - p.num_of_reads))::BIGINT END AS avg_read_stall_ms,
 num_of_reads - p.num_of_reads AS reads, (bytes_read - p.bytes_read) / 1048576.0::DOUBLE AS mb_read,
 io_stall_write_ms - p.io_stall_write_ms AS write_stall_ms,
 CASE WHEN num_of_writes = p.num_of_writes THEN 0 ELSE trunc((io_stall_write_ms - p.io_stall_write_ms) / (num_of_writes - p.num_of_writes))::BIGINT END AS avg_write_stall_ms,
 num_of_writes - p.num_of_writes AS writes, (bytes_written - p.bytes_written) / 1048576.0::DOUBLE AS mb_written"""


@report("I04_file_io_delta", f"""
SELECT server_id, file, {stamp('check_date')} AS check_date, date_diff('second', p.check_date, check_date) AS elapsed_seconds, {FILE_CHANGE}
FROM (SELECT *, lag(f) OVER (PARTITION BY server_id, file ORDER BY check_date) AS p FROM {FILE_STATS} f)
WHERE num_of_reads >= p.num_of_reads AND num_of_writes >= p.num_of_writes AND date_diff('minute', p.check_date, check_date) BETWEEN 1 AND 1440""")
def _(db):
    return tm.file_io_delta(file_stats(db), ["server_id", "file"], "check_date", max_gap=1440)


@report("I05_file_io_asof", f"""
SELECT server_id, left(file, 2) AS drive, file, CASE WHEN num_of_reads = 0 THEN 0 ELSE io_stall_read_ms // num_of_reads END AS read_latency,
 CASE WHEN num_of_writes = 0 THEN 0 ELSE io_stall_write_ms // num_of_writes END AS write_latency,
 CASE WHEN num_of_reads + num_of_writes = 0 THEN 0 ELSE (io_stall_read_ms + io_stall_write_ms) // (num_of_reads + num_of_writes) END AS latency,
 CASE WHEN num_of_reads = 0 THEN 0 ELSE bytes_read // num_of_reads END AS bytes_per_read,
 CASE WHEN num_of_writes = 0 THEN 0 ELSE bytes_written // num_of_writes END AS bytes_per_write,
 CASE WHEN num_of_reads + num_of_writes = 0 THEN 0 ELSE (bytes_read + bytes_written) // (num_of_reads + num_of_writes) END AS bytes_per_transfer
FROM {FILE_STATS} WHERE check_date = TIMESTAMP '2024-01-15'""")
def _(db):
    d = tm.file_io_asof(file_stats(db), "check_date", b.lit_ts("2024-01-15"), "file")
    return d.select("server_id", "drive", "file", "read_latency", "write_latency", "latency", "bytes_per_read", "bytes_per_write", "bytes_per_transfer")


@report("I06_delta_between", f"""
WITH f AS (SELECT * FROM {FILE_STATS} WHERE check_date BETWEEN TIMESTAMP '2024-01-04 12:00:00' AND TIMESTAMP '2024-01-21 12:00:00'),
 lo AS (SELECT * FROM f WHERE check_date = (SELECT min(check_date) FROM f)), hi AS (SELECT * FROM f WHERE check_date = (SELECT max(check_date) FROM f))
SELECT hi.server_id, hi.file, {stamp('hi.check_date')} AS check_date, date_diff('second', p.check_date, hi.check_date) AS elapsed_seconds,
 {FILE_CHANGE.replace("size_mb - p", "hi.size_mb - p").replace("io_stall_read_ms - p", "hi.io_stall_read_ms - p").replace("num_of_reads - p", "hi.num_of_reads - p").replace("num_of_reads = p", "hi.num_of_reads = p").replace("bytes_read - p", "hi.bytes_read - p").replace("io_stall_write_ms - p", "hi.io_stall_write_ms - p").replace("num_of_writes - p", "hi.num_of_writes - p").replace("num_of_writes = p", "hi.num_of_writes = p").replace("bytes_written - p", "hi.bytes_written - p")}
FROM hi JOIN lo p ON p.server_id = hi.server_id AND p.file = hi.file WHERE hi.num_of_reads >= p.num_of_reads AND hi.num_of_writes >= p.num_of_writes""")
def _(db):
    return tm.delta_between(file_stats(db), ["server_id", "file"], "check_date", b.lit_ts("2024-01-04 12:00:00"), b.lit_ts("2024-01-21 12:00:00"))


def typed_counters(db):
    """Counters of every type per server and day."""
    k = E("cast(get_json_object(props, '$.k') as bigint)")
    c = E("cast(round(value * 100) as bigint)")
    day = db.events.withColumn("k", k).withColumn("c", c).groupBy(
        (F.col("user_id") % 10).alias("server_id"), F.date_trunc("day", "ts").cast("timestamp_ntz").alias("check_date")
    ).agg(F.sum("c").alias("c"), F.sum("k").alias("k"), F.count("*").alias("n"))
    kinds = [("Log Flushes/sec", 272696576, "c * 1000"), ("Average Latch Wait Time (ms)", 1073874176, "c"), ("Average Latch Wait Time Base", 1073939712, "n"),
             ("Cache Hit Ratio", 537003264, "k"), ("Cache Hit Ratio Base", 1073939712, "n"), ("Page life expectancy", 65792, "k")]
    rows = F.array(*[F.struct(F.lit(n).alias("counter_name"), F.lit(t).alias("cntr_type"), E(f"cast({v} as bigint)").alias("cntr_value")) for n, t, v in kinds])
    return day.select("server_id", "check_date", F.inline(rows))


DAYC = """day AS (SELECT user_id % 10 AS server_id, date_trunc('day', ts)::TIMESTAMP AS check_date, sum(cast(round(value * 100) AS BIGINT))::BIGINT AS c,
 sum((props->>'$.k')::BIGINT)::BIGINT AS k, count(*) AS n FROM events GROUP BY 1, 2),
 dl AS (SELECT *, c - lag(c) OVER w AS dc, k - lag(k) OVER w AS dk, n - lag(n) OVER w AS dn, date_diff('second', lag(check_date) OVER w, check_date) AS el FROM day WINDOW w AS (PARTITION BY server_id ORDER BY check_date))"""


@report("I07_interpret_counters", f"""
WITH {DAYC} SELECT server_id, {stamp('check_date')} AS check_date, counter_name, v AS cntr_value FROM (
 SELECT server_id, check_date, 'Log Flushes/sec' AS counter_name, trunc(dc * 1000 / el)::DOUBLE AS v FROM dl WHERE dc <> 0 AND el <= 86400
 UNION ALL SELECT server_id, check_date, 'Average Latch Wait Time (ms)', trunc(dc / dn)::DOUBLE FROM dl WHERE dc <> 0 AND dn <> 0 AND el <= 86400
 UNION ALL SELECT server_id, check_date, 'Cache Hit Ratio', round(dk / dn, 3) FROM dl WHERE dk <> 0 AND dn <> 0 AND el <= 86400
 UNION ALL SELECT server_id, check_date, 'Page life expectancy', k::DOUBLE FROM dl WHERE el <= 86400)""")
def _(db):
    d = tm.counter_delta(typed_counters(db).withColumnRenamed("check_date", "t"), ["server_id", "counter_name", "cntr_type"], "t", ["cntr_value"], max_gap=1440)
    return tm.interpret_counters(d, ["server_id"], "t").withColumnRenamed("t", "check_date")


@report("I08_ratio_counters", f"""
WITH {DAYC} SELECT server_id, {stamp('check_date')} AS check_date, 'Cache Hit Ratio' AS counter_name, CASE WHEN n <> 0 THEN k * 100 // n ELSE k END AS cntr_value FROM day""")
def _(db):
    return tm.ratio_counters(typed_counters(db), ["server_id", "check_date"]).select("server_id", "check_date", "counter_name", "cntr_value")


@report("I09_two_sample_rate", f"""
WITH x AS (SELECT user_id, event_type, ts, cast(round(value * 100) AS BIGINT) AS v, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS up,
 row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS dn FROM events)
SELECT a.user_id, a.event_type, {stamp('a.ts')} AS time1, {stamp('z.ts')} AS time2, trunc((z.v - a.v)::DOUBLE / date_diff('second', a.ts, z.ts))::BIGINT AS rate
FROM x a JOIN x z ON a.user_id = z.user_id AND a.event_type = z.event_type AND a.up = 1 AND z.dn = 1 WHERE a.ts < z.ts""")
def _(db):
    v = db.events.withColumn("v", E("cast(round(value * 100) as bigint)"))
    keys = ["user_id", "event_type"]
    edge = lambda f: v.groupBy(*keys).agg(f(F.struct("ts", "event_id", "v")).alias("s")).select(*keys, "s.ts", "s.v")
    return tm.two_sample_rate(edge(F.min), edge(F.max), keys, "ts", "v")


@report("I10_wait_snapshot", f"""
SELECT server_id, {stamp('check_date')} AS check_date, wait_type, wait_time_ms / 1000.0::DOUBLE AS wait_s, (wait_time_ms - signal_wait_time_ms) / 1000.0::DOUBLE AS resource_s, signal_wait_time_ms / 1000.0::DOUBLE AS signal_s,
 waiting_tasks_count AS wait_count, wait_time_ms * 100.0::DOUBLE / (sum(wait_time_ms) OVER (PARTITION BY server_id, check_date))::DOUBLE AS percentage,
 row_number() OVER (PARTITION BY server_id, check_date ORDER BY wait_time_ms DESC, wait_type) AS row_num
FROM {b.WAIT_STATS} WHERE wait_type <> 'SLEEP_TASK' AND waiting_tasks_count > 0""")
def _(db):
    return tm.wait_snapshot(b.wait_stats(db), ["server_id", "check_date"]).select(
        "server_id", "check_date", "wait_type", "wait_s", "resource_s", "signal_s", "wait_count", "percentage", "row_num")


def pareto_sql(threshold):
    return f"""
WITH u AS (SELECT user_id, sum(cast(round(value * 100) AS BIGINT))::BIGINT AS cents FROM events GROUP BY 1),
 r AS (SELECT *, sum(cents) OVER (ORDER BY cents DESC, user_id ROWS UNBOUNDED PRECEDING)::BIGINT AS run, (sum(cents) OVER ())::BIGINT AS total FROM u)
SELECT user_id, cents, cents * 100.0::DOUBLE / total AS percentage, run * 100.0::DOUBLE / total AS cumulative FROM r WHERE (run - cents) * 100.0::DOUBLE / total < {threshold}"""


def _pareto(db, threshold):
    u = db.events.groupBy("user_id").agg(E("sum(cast(round(value * 100) as bigint))").alias("cents"))
    return tm.pareto(u, "cents", ["user_id"], threshold)


@report("I11_pareto", pareto_sql(95))
def _(db):
    return _pareto(db, 95)


@report("I11_pareto_99", pareto_sql(99))
def _(db):
    return _pareto(db, 99)


@report("I12_wait_delta", f"""
WITH s AS {b.WAIT_STATS}, clr AS (SELECT server_id, check_date + INTERVAL 6 HOUR AS t FROM s WHERE wait_type = 'SLEEP_TASK' AND isodow(check_date) = 1 AND check_date + INTERVAL 6 HOUR BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-28'),
 pts AS (SELECT server_id, t FROM clr UNION SELECT server_id, unnest([TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-28']) FROM (SELECT DISTINCT server_id FROM s)),
 rg AS (SELECT server_id, row_number() OVER w AS range_id, t AS lower, lead(t) OVER w AS upper, count(*) OVER (PARTITION BY server_id) - 1 AS nr FROM pts WINDOW w AS (PARTITION BY server_id ORDER BY t)),
 x AS (SELECT s.*, range_id FROM s JOIN rg ON s.server_id = rg.server_id AND upper IS NOT NULL AND (check_date > lower OR (range_id = 1 AND check_date = lower)) AND (check_date < upper OR (range_id = nr AND check_date = upper))),
 e AS (SELECT *, min(check_date) OVER (PARTITION BY server_id, range_id) AS t1, max(check_date) OVER (PARTITION BY server_id, range_id) AS t2 FROM x),
 d AS (SELECT server_id, range_id, wait_type, max(t2) AS collection_time, date_diff('second', max(t1), max(t2)) AS duration_seconds,
  (sum(CASE WHEN check_date = t2 THEN wait_time_ms ELSE 0 END) - sum(CASE WHEN check_date = t1 THEN wait_time_ms ELSE 0 END))::BIGINT AS wait_time_ms,
  (sum(CASE WHEN check_date = t2 THEN signal_wait_time_ms ELSE 0 END) - sum(CASE WHEN check_date = t1 THEN signal_wait_time_ms ELSE 0 END))::BIGINT AS signal_wait_time_ms,
  (sum(CASE WHEN check_date = t2 THEN waiting_tasks_count ELSE 0 END) - sum(CASE WHEN check_date = t1 THEN waiting_tasks_count ELSE 0 END))::BIGINT AS waiting_tasks_count
  FROM e WHERE check_date IN (t1, t2) GROUP BY 1, 2, 3),
 f AS (SELECT *, (sum(wait_time_ms) OVER (PARTITION BY server_id, range_id))::BIGINT AS total, (sum(wait_time_ms) OVER (PARTITION BY server_id, range_id ORDER BY wait_time_ms DESC, wait_type ROWS UNBOUNDED PRECEDING))::BIGINT AS run FROM d WHERE waiting_tasks_count > 0 AND wait_time_ms >= 0)
SELECT server_id, range_id, wait_type, {stamp('collection_time')} AS collection_time, duration_seconds, wait_time_ms, signal_wait_time_ms, waiting_tasks_count,
 wait_time_ms * 100.0::DOUBLE / total AS percentage, run * 100.0::DOUBLE / total AS cumulative FROM f WHERE (run - wait_time_ms) * 100.0::DOUBLE / total < 95""")
def _(db):
    s = durable(b.wait_stats(db))  # daily sums, read several times
    at = F.col("check_date") + E("interval 6 hours")
    clears = s.filter("wait_type = 'SLEEP_TASK' and weekday(check_date) = 0").select("server_id", at.alias("cleared"))
    every = s.select("server_id", F.lit(None).cast("timestamp_ntz").alias("cleared")).distinct()  # servers without a clear
    return tm.wait_delta(s, clears.unionByName(every), ["server_id"], "check_date", "cleared", b.lit_ts("2024-01-03"), b.lit_ts("2024-01-28"))


def categories(db):
    rows = F.array(*[F.struct(F.lit(w).alias("wait_type"), F.lit(c).alias("wait_category"), F.lit(i).alias("ignorable")) for w, c, i in b.WAIT_CATEGORY])
    return db.spark.range(1).select(F.inline(rows))


@report("I13_wait_delta_view", f"""
WITH l AS (SELECT *, lag(s) OVER (PARTITION BY server_id, wait_type ORDER BY check_date) AS p FROM {b.WAIT_STATS} s)
SELECT server_id, {stamp('l.check_date')} AS check_date, wait_type, coalesce(c.cat, 'Other') AS wait_category, coalesce(c.ign, 0)::BIGINT AS ignorable,
 date_diff('second', p.check_date, l.check_date) AS elapsed_seconds, wait_time_ms - p.wait_time_ms AS wait_time_ms_delta,
 (wait_time_ms - p.wait_time_ms) / 60000.0::DOUBLE AS wait_minutes_delta, (wait_time_ms - p.wait_time_ms) / 1000.0::DOUBLE / date_diff('second', p.check_date, l.check_date) AS wait_minutes_per_minute,
 waiting_tasks_count - p.waiting_tasks_count AS waiting_tasks_count_delta
FROM l LEFT JOIN (VALUES {", ".join(str(c) for c in b.WAIT_CATEGORY)}) c(w, cat, ign) ON c.w = wait_type
WHERE wait_time_ms >= p.wait_time_ms AND date_diff('minute', p.check_date, l.check_date) BETWEEN 1 AND 1440""")
def _(db):
    d = tm.wait_delta_view(b.wait_stats(db), categories(db), ["server_id"], "check_date", max_gap=1440)
    return d.select("server_id", "check_date", "wait_type", "wait_category", "ignorable", "elapsed_seconds", "wait_time_ms_delta",
                    "wait_minutes_delta", "wait_minutes_per_minute", "waiting_tasks_count_delta")


@report("I14_time_bucket", f"SELECT event_id, {stamp('''time_bucket(INTERVAL '10 minutes', ts)''')} AS bucket FROM events")
def _(db):
    return db.events.select("event_id", clock.time_bucket("ts", 10).alias("bucket"))


ROLL = """SELECT time_bucket(INTERVAL '{m} minutes', ts) AS t, event_type, sum(cast(round(value * 100) AS BIGINT))::BIGINT AS s, count(*) AS n FROM events GROUP BY 1, 2"""


@report("I15_rollup_avg", f"SELECT {stamp('t')} AS collection_time, event_type AS counter_name, s // n AS cntr_value FROM ({ROLL.format(m=60)})")
def _(db):
    return ro.rollup_avg(b.counters(db), ["counter_name"], "collection_time", 60, ["cntr_value"])


@report("I16_rollup_first", f"""
SELECT server_id, wait_type, {stamp('check_date')} AS check_date, wait_time_ms FROM {b.WAIT_STATS} s
WHERE (server_id, check_date) IN (SELECT (server_id, min(check_date)) FROM {b.WAIT_STATS} GROUP BY server_id, time_bucket(INTERVAL '4320 minutes', check_date, TIMESTAMP '1970-01-01'))""")
def _(db):
    return ro.rollup_first(b.wait_stats(db), "check_date", 4320, ["server_id"]).select("server_id", "wait_type", "check_date", "wait_time_ms")


@report("I17_tier_policy", f"""
SELECT 'raw' AS tier, {stamp('ts')} AS collection_time, event_type AS counter_name, cast(round(value * 100) AS BIGINT) AS cntr_value FROM events WHERE ts >= TIMESTAMP '2024-01-24'
UNION ALL SELECT '10min', {stamp('t')}, event_type, s // n FROM ({ROLL.format(m=10)}) WHERE t >= TIMESTAMP '2024-01-16' AND t < TIMESTAMP '2024-01-24'
UNION ALL SELECT '60min', {stamp('t')}, event_type, s // n FROM ({ROLL.format(m=60)}) WHERE t >= TIMESTAMP '2024-01-06' AND t < TIMESTAMP '2024-01-16'""")
def _(db):
    policy = ro.TierPolicy([ro.Tier("raw", 0, 7), ro.Tier("10min", 10, 15), ro.Tier("60min", 60, 25)], ["counter_name"], "collection_time", ["cntr_value"])
    return policy.view(b.counters(db), b.lit_ts("2024-01-31 05:00:00"))


@report("I26_trend_text", """
WITH x AS (SELECT *, row_number() OVER (PARTITION BY event_type, date_trunc('minute', ts) ORDER BY ts) AS rn FROM events WHERE ts >= TIMESTAMP '2024-01-30')
SELECT event_type AS counter_name, string_agg(cast(round(value * 100) AS BIGINT)::VARCHAR, ' <- ' ORDER BY ts DESC) AS trend FROM x WHERE rn = 1 GROUP BY 1""")
def _(db):
    return tm.trend_text(b.counters(db), ["counter_name"], "collection_time", "cntr_value", 1440, b.lit_ts("2024-01-31"))


@report("I27_per_cpu", """
WITH s AS (SELECT user_id, event_id, ts, event_type, cast(round(value * 100) AS BIGINT) AS v FROM events WHERE event_type IN ('error', 'view')),
 i AS (SELECT user_id, ts, (props->>'$.k')::BIGINT % 16 + 1 AS cpu FROM events WHERE event_type = 'signup')
SELECT event_id, event_type AS counter_name, CASE WHEN event_type = 'error' THEN v // cpu ELSE v END AS cntr_value FROM s ASOF LEFT JOIN i ON s.user_id = i.user_id AND s.ts >= i.ts""")
def _(db):
    c = b.counters(db)
    info = c.filter("counter_name = 'signup'").select("server_id", "collection_time", (F.col("k") % 16 + 1).alias("cpu_count"))
    d = tm.per_cpu(c.filter("counter_name in ('error', 'view')"), info, ["server_id"], "collection_time", "cntr_value", ["error"])
    return d.select("event_id", "counter_name", "cntr_value")


@report("I28_large_instances", f"""
SELECT event_id FROM {b.COUNTERS} WHERE server_id IN (SELECT server_id FROM {b.COUNTERS} WHERE counter_name = 'view' AND cntr_value > 5000)""")
def _(db):
    return tm.large_instances(b.counters(db), "server_id", "view", 5000).select("event_id")
