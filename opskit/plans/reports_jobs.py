"""Jobs, capacity and experiments."""

from pyspark.sql import functions as F

from opskit.operators import capacity as cp
from opskit.operators import experiments as ex
from opskit.operators import jobs as jb
from opskit.plans import bindings as b
from opskit.plans.registry import report, stamp

E = F.expr
MINS = "((run_duration // 10000) * 60 + (run_duration // 100) % 100 + CASE WHEN run_duration % 100 > 29 THEN 1 ELSE 0 END)"
BUCKET = "CASE " + " ".join(f"WHEN m // 60 >= {h} THEN '{h}-Hrs'" for h in jb.HOURS) + " ELSE '<3-Hrs' END"


def hist_sql(cond):
    cols = ", ".join(f"count(*) FILTER (bk = '{n}') AS \"{n}\"" for n in jb.BUCKETS)
    return f"(SELECT job_name, max(instance_id) AS instance_id, {cols} FROM (SELECT *, {BUCKET} AS bk FROM (SELECT *, {MINS} AS m FROM {b.JOB_HISTORY} WHERE step_id = 0 AND {cond})) GROUP BY 1)"


@report("I47_duration_histogram", f"SELECT * FROM {hist_sql('true')}")
def _(db):
    return jb.duration_histogram(b.job_history(db))


@report("I48_merge_histogram", f"""
WITH o AS {hist_sql("run_date < 19980101")}, n AS {hist_sql("run_date >= 19980101")}
SELECT job_name, coalesce(n.instance_id, o.instance_id) AS instance_id, {", ".join(f'coalesce(o."{c}", 0) + coalesce(n."{c}", 0) AS "{c}"' for c in jb.BUCKETS)} FROM o FULL JOIN n USING (job_name)""")
def _(db):
    h = b.job_history(db)
    return jb.merge_histogram(jb.duration_histogram(h.filter("run_date < 19980101")), jb.duration_histogram(h.filter("run_date >= 19980101")))


@report("I49_last_duration", f"""
WITH d AS (SELECT job_name, CASE run_status WHEN 0 THEN 'Failed' WHEN 1 THEN 'Succeeded' WHEN 3 THEN 'Canceled' END AS st, run_date * 1000000 + run_time AS run_at,
 ((run_duration // 10000 * 3600 + (run_duration // 100) % 100 * 60 + run_duration % 100 + 31) // 60) AS m FROM {b.JOB_HISTORY} WHERE step_id = 0),
 l AS (SELECT job_name, st, (m // 60) || ':' || (m % 60) AS du FROM d QUALIFY row_number() OVER (PARTITION BY job_name, st ORDER BY run_at DESC, (m // 60) || ':' || (m % 60) DESC) = 1),
 w AS (SELECT job_name, max(du) FILTER (st = 'Succeeded') AS succeeded, max(du) FILTER (st = 'Canceled') AS canceled, max(du) FILTER (st = 'Failed') AS failed, max(du) FILTER (st = 'Retry') AS retry FROM l GROUP BY 1)
SELECT *, coalesce(succeeded, canceled, failed, retry) AS last_duration FROM w""")
def _(db):
    return jb.last_duration(b.job_history(db))


@report("I50_failed_steps", f"""
WITH h AS {b.JOB_HISTORY}, m AS (SELECT job_name, min(instance_id) AS after FROM (SELECT *, row_number() OVER (PARTITION BY job_name ORDER BY instance_id DESC) AS rn FROM h WHERE step_id = 0) WHERE rn <= 2 GROUP BY 1)
SELECT job_name, instance_id, step_id FROM h JOIN m USING (job_name) WHERE step_id <> 0 AND run_status = 0 AND instance_id > after""")
def _(db):
    return jb.failed_steps(b.job_history(db)).select("job_name", "instance_id", "step_id")


def schedules(db):
    kinds = F.array(*[F.lit(x) for x in (1, 4, 8, 16, 32, 64, 128, 2)])
    k = F.col("o_orderkey")
    subday = F.array(*[F.lit(x) for x in (1, 2, 4, 8, 9)])
    rel = F.array(*[F.lit(x) for x in (1, 2, 4, 8, 16)])
    return db.orders.select(
        "o_orderkey", F.get(kinds, (k % 8).cast("int")).alias("freq_type"), (F.col("o_custkey") % 10 + 1).alias("freq_interval"), (k % 3 + 1).alias("freq_recurrence_factor"),
        F.get(rel, (k % 5).cast("int")).alias("freq_relative_interval"), F.get(subday, (F.col("o_custkey") % 5).cast("int")).alias("freq_subday_type"), (k % 50 + 1).alias("freq_subday_interval"),
        ((k % 24) * 10000 + (k % 60) * 100).alias("active_start_time"), F.when(k % 6 == 0, 0).otherwise(F.date_format("o_orderdate", "yyyyMMdd").cast("int")).alias("next_run_date"),
        ((k % 24) * 10000 + 3059).alias("next_run_time"))


def hms(c):
    return f"(substr(lpad({c}::VARCHAR, 6, '0'), 1, 2) || ':' || substr(lpad({c}::VARCHAR, 6, '0'), 3, 2) || ':' || substr(lpad({c}::VARCHAR, 6, '0'), 5, 2))"


@report("I51_describe_schedule", f"""
WITH s AS (SELECT o_orderkey, [1, 4, 8, 16, 32, 64, 128, 2][o_orderkey % 8 + 1] AS ft, o_custkey % 10 + 1 AS fi, o_orderkey % 3 + 1 AS rf, [1, 2, 4, 8, 16][o_orderkey % 5 + 1] AS ri, [1, 2, 4, 8, 9][o_custkey % 5 + 1] AS sd,
 o_orderkey % 50 + 1 AS sn, (o_orderkey % 24) * 10000 + (o_orderkey % 60) * 100 AS st, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS nd, (o_orderkey % 24) * 10000 + 3059 AS nt FROM orders)
SELECT o_orderkey, CASE ft WHEN 1 THEN 'Once' WHEN 4 THEN 'Daily' WHEN 8 THEN CASE WHEN rf > 1 THEN 'Every ' || rf || ' Weeks' ELSE 'Weekly' END WHEN 16 THEN CASE WHEN rf > 1 THEN 'Every ' || rf || ' Months' ELSE 'Monthly' END
  WHEN 32 THEN 'Every ' || rf || ' Months' WHEN 64 THEN 'SQL Startup' WHEN 128 THEN 'SQL Idle' ELSE '??' END AS frequency,
 CASE WHEN ft = 1 THEN 'One time only' WHEN ft = 4 AND fi = 1 THEN 'Every Day' WHEN ft = 4 AND fi > 1 THEN 'Every ' || fi || ' Days'
  WHEN ft = 8 THEN CASE WHEN fi & 1 <> 0 THEN 'Sun ' ELSE '' END || CASE WHEN fi & 2 <> 0 THEN 'Mon ' ELSE '' END || CASE WHEN fi & 4 <> 0 THEN 'Tue ' ELSE '' END || CASE WHEN fi & 8 <> 0 THEN 'Wed ' ELSE '' END
  WHEN ft = 16 THEN 'Day ' || fi WHEN ft = 32 THEN CASE ri WHEN 1 THEN 'First' WHEN 2 THEN 'Second' WHEN 4 THEN 'Third' WHEN 8 THEN 'Fourth' ELSE 'Last' END || ' ' || ['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Day', 'Weekday', 'Weekend'][fi] END AS "interval",
 CASE sd WHEN 1 THEN {hms('st')} WHEN 2 THEN 'Every ' || sn || ' seconds' WHEN 4 THEN 'Every ' || sn || ' minutes' WHEN 8 THEN 'Every ' || sn || ' hours' ELSE '??' END AS at,
 CASE WHEN nd IS NULL THEN 'n/a' ELSE nd || ' ' || {hms('nt')} END AS next_run FROM s""")
def _(db):
    return jb.describe_schedule(schedules(db)).select("o_orderkey", "frequency", "interval", "at", "next_run")


@report("I52_balance", "SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) % 4 + 1 AS batch FROM part")
def _(db):
    return jb.balance(db.part, "p_retailprice", 4, ["p_partkey"]).select("p_partkey", "batch")


@report("I53_interleave", """
WITH f AS (SELECT p_partkey, p_retailprice, CASE WHEN p_size < 10 THEN 1 ELSE 0 END AS flag FROM part), n AS (SELECT CASE WHEN count(*) > 1 THEN min(c) ELSE 50 END AS n FROM (SELECT count(*) AS c FROM f GROUP BY flag)),
 o AS (SELECT *, row_number() OVER (PARTITION BY flag ORDER BY p_retailprice DESC, p_partkey) AS order_id, count(*) OVER (PARTITION BY flag) AS cnt FROM f),
 t AS (SELECT o.*, CASE WHEN order_id <= (cnt % n) * (cnt // n + 1) THEN (order_id - 1) // (cnt // n + 1) + 1 ELSE cnt % n + (order_id - 1 - (cnt % n) * (cnt // n + 1)) // greatest(cnt // n, 1) + 1 END AS tile FROM o, n)
SELECT p_partkey, flag::BIGINT AS flag, tile::BIGINT AS tile, order_id, row_number() OVER (ORDER BY tile, order_id, flag) AS position FROM t""")
def _(db):
    d = db.part.select("p_partkey", "p_retailprice", E("CASE WHEN p_size < 10 THEN 1 ELSE 0 END").alias("flag"))
    return jb.interleave(d, "flag", "p_retailprice", ["p_partkey"]).select("p_partkey", "flag", "tile", "order_id", "position")


@report("I54_maintenance_candidates", """
SELECT o_orderkey FROM orders WHERE (o_totalprice / 100 >= 1000 AND o_custkey % 100 >= 30) OR (o_orderkey % 900 > 0 AND o_orderkey % 900 >= sqrt(o_custkey * 1000.0))""")
def _(db):
    d = db.orders.select("o_orderkey", E("o_totalprice / 100").alias("pages"), E("o_custkey % 100").alias("fragmentation"), E("o_orderkey % 900").alias("modified"), F.col("o_custkey").alias("row_count"))
    return cp.maintenance_candidates(d).select("o_orderkey")


@report("I55_capacity", f"""
WITH p AS (SELECT file_id, db_name, type_desc, size_mb, used_mb, arg_max(volume, length(volume)) AS volume, arg_max(capacity_mb, length(volume)) AS capacity_mb FROM {b.FILES} f JOIN {b.VOLUMES} v ON starts_with(path, volume) GROUP BY ALL)
SELECT volume, db_name, type_desc, max(capacity_mb) AS capacity_mb, count(*) AS files, sum(size_mb)::BIGINT AS size_mb, sum(used_mb)::BIGINT AS used_mb, (sum(size_mb) - sum(used_mb))::BIGINT AS free_mb, (sum(size_mb) // 1024)::BIGINT AS size_gb,
 sum(used_mb)::BIGINT * 100.0::DOUBLE / sum(size_mb)::BIGINT AS used_percent, sum(size_mb)::BIGINT * 100.0::DOUBLE / max(capacity_mb) AS volume_percent FROM p GROUP BY 1, 2, 3""")
def _(db):
    return cp.capacity(b.files(db), b.volumes(db))


@report("I56_growth", f"""
SELECT db_name, coalesce(max(used_mb) FILTER (type_desc = 'ROWS') - min(used_mb) FILTER (type_desc = 'ROWS'), 0) AS data_growth, coalesce(max(used_mb) FILTER (type_desc = 'LOG') - min(used_mb) FILTER (type_desc = 'LOG'), 0) AS log_growth
FROM {b.FILES} WHERE collection_time BETWEEN TIMESTAMP '2024-01-01 01:00:00' AND TIMESTAMP '2024-01-01 03:00:00' GROUP BY 1""")
def _(db):
    return cp.growth(b.files(db), "collection_time", b.lit_ts("2024-01-01 03:00:00"))


@report("I56_space_alerts", f"""
SELECT db_name, d::BIGINT AS data_mb, l::BIGINT AS store_mb FROM (SELECT db_name, sum(CASE WHEN type_desc = 'ROWS' THEN used_mb ELSE 0 END) AS d, sum(CASE WHEN type_desc = 'LOG' THEN used_mb ELSE 0 END) AS l FROM {b.FILES} GROUP BY 1) WHERE l >= 60000 OR l >= d * 0.3""")
def _(db):
    return cp.space_alerts(b.files(db), ["db_name"], 60000)


@report("I57_space_to_add", f"""
WITH p AS (SELECT db_name, sum(size_mb)::DOUBLE AS size FROM {b.FILES} GROUP BY 1), a AS (SELECT * FROM p UNION ALL SELECT 'scratch', sum(size)::BIGINT * 0.2::DOUBLE FROM p) SELECT db_name, round(size, 4) AS size, round(greatest(size / (1 - 35 / 100.0::DOUBLE) - size, 0), 4) AS to_add FROM a""")
def _(db):
    d = cp.space_requirement(b.files(db), "db_name", "size_mb")
    return d.select("db_name", F.round("size", 4).alias("size"), F.round("to_add", 4).alias("to_add"))


@report("I58_estimate_total", """
SELECT count(*) AS entities, count(top) AS known, sum(top)::BIGINT AS total FROM customer LEFT JOIN (SELECT o_custkey, max(floor(o_totalprice)::BIGINT) AS top FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey""")
def _(db):
    h = db.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"), F.floor("o_totalprice").alias("size"))
    return cp.estimate_total(h, db.customer, "c_custkey", "size")


@report("I59_freshness", f"""
WITH d AS (SELECT o_orderkey, o_orderkey // 5000 AS batch, CASE WHEN o_orderstatus <> 'P' THEN TIMESTAMP '2024-01-31' - to_hours(o_custkey % 400) END AS last FROM orders)
SELECT o_orderkey, {stamp('last')} AS last_full, CASE WHEN last IS NULL OR date_diff('hour', last, TIMESTAMP '2024-01-31') >= 24 THEN 'No' ELSE 'Yes' END AS full_backup_24h,
 CASE WHEN last IS NULL OR date_diff('day', last, TIMESTAMP '2024-01-31') >= 7 THEN 'No' ELSE 'Yes' END AS full_backup_7d FROM d WHERE batch = (SELECT max(batch) FROM d)""")
def _(db):
    now = b.lit_ts("2024-01-31 00:00:00")
    d = db.orders.select("o_orderkey", E("o_orderkey div 5000").alias("batch"), F.when(F.col("o_orderstatus") != "P", now - F.make_dt_interval(hours=(F.col("o_custkey") % 400).cast("int"))).alias("last_full"))
    return cp.freshness(d, "batch", "last_full", now).drop("batch")


BK = """(SELECT o_orderkey AS id, 'db' || (o_custkey % 300) AS db_name, CASE o_orderstatus WHEN 'F' THEN 'D' WHEN 'O' THEN 'I' ELSE 'L' END AS type, o_orderdate AS start_time, floor(o_totalprice)::BIGINT AS size,
 'N:/bk' || (o_custkey % 4) || '/d' || (o_orderkey % 3) || '/f' || o_orderkey || CASE o_orderstatus WHEN 'P' THEN '.trn' ELSE '.bak' END AS path FROM orders)"""


def backups(db):
    return db.orders.select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("db"), F.col("o_custkey") % 300).alias("db_name"), E("CASE o_orderstatus WHEN 'F' THEN 'D' WHEN 'O' THEN 'I' ELSE 'L' END").alias("type"),
        F.col("o_orderdate").alias("start_time"), F.floor("o_totalprice").alias("size"),
        E("concat('N:/bk', o_custkey % 4, '/d', o_orderkey % 3, '/f', o_orderkey, CASE o_orderstatus WHEN 'P' THEN '.trn' ELSE '.bak' END)").alias("path"))


@report("I60_latest_full", f"""
SELECT db_name, id, size, row_number() OVER (ORDER BY size DESC, db_name) AS size_rank FROM (SELECT * FROM {BK} WHERE type = 'D' QUALIFY row_number() OVER (PARTITION BY db_name ORDER BY start_time DESC, id DESC) = 1)""")
def _(db):
    return cp.latest_full(backups(db), "db_name", "start_time", "size", "id").select("db_name", "id", "size", "size_rank")


@report("I61_next_in_chain", f"""
WITH k AS {BK}, a AS (SELECT db_name, arg_max(path, id) AS last_file, arg_max(start_time, id) AS last_start, arg_max(start_time, id) AS last_log FROM k WHERE type = 'L' AND start_time < TIMESTAMP '1996-06-01' GROUP BY 1),
 f AS (SELECT db_name, min(start_time) AS last_full FROM k WHERE type = 'D' GROUP BY 1)
SELECT k.db_name, k.id FROM k LEFT JOIN (SELECT * FROM a LEFT JOIN f USING (db_name)) x USING (db_name) WHERE k.type = 'L'
 AND (CASE WHEN coalesce(last_full >= last_log, false) THEN NULL ELSE last_file END IS NULL OR (k.start_time >= last_start AND k.path <> last_file))""")
def _(db):
    k = backups(db)
    last = k.filter("type = 'L' and start_time < timestamp_ntz'1996-06-01'").groupBy("db_name").agg(
        F.max_by("path", "id").alias("last_file"), F.max_by("start_time", "id").alias("last_start"), F.max_by("start_time", "id").alias("last_log"))
    full = k.filter("type = 'D'").groupBy("db_name").agg(F.min("start_time").alias("last_full"))
    logs = k.filter("type = 'L'").withColumnRenamed("path", "file_name")
    return cp.next_in_chain(logs, last.join(full, "db_name", "left")).select("db_name", "id")


@report("I63_buffer_usage", """
SELECT l_suppkey, count(*) AS pages, sum(l_partkey)::BIGINT AS free_bytes, count(*) * 8 // 1024 AS used_mb, (sum(l_partkey) // 1048576)::BIGINT AS empty_mb, sum(l_partkey)::BIGINT * 100.0::DOUBLE / (count(*) * 8192) AS empty_percent FROM lineitem GROUP BY 1""")
def _(db):
    return cp.buffer_usage(db.lineitem, "l_suppkey", "l_partkey")


@report("I65_compare_runs", """
SELECT l_linenumber::BIGINT AS l_linenumber, d.* , least(F, O) AS best, CASE WHEN F <= O THEN 'F' ELSE 'O' END AS winner FROM (SELECT l_linenumber, sum(l_quantity) FILTER (l_linestatus = 'F') / count(*) FILTER (l_linestatus = 'F') AS F, sum(l_quantity) FILTER (l_linestatus = 'O') / count(*) FILTER (l_linestatus = 'O') AS O FROM lineitem GROUP BY 1) d""".replace("d.* ,", "F, O,"))
def _(db):
    return ex.compare_runs(db.lineitem, ["l_linenumber"], "l_linestatus", ["F", "O"], "l_quantity")


@report("I66_weighted_score", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, round(l_quantity * l_partkey * (l_suppkey * 0.01::DOUBLE), 2) AS advantage FROM lineitem""")
def _(db):
    return cp.weighted_score(db.lineitem, "l_quantity", "l_partkey", "l_suppkey").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "advantage")


@report("I71_latest_paths", f"""
WITH l AS (SELECT *, CASE type WHEN 'D' THEN 'Database' WHEN 'I' THEN 'Differential' ELSE 'Log' END AS backup_type, array_to_string(string_split(path, '/')[1:3], '/') AS folder, right(path, 3) AS extension FROM {BK} QUALIFY row_number() OVER (PARTITION BY db_name, type ORDER BY start_time DESC, id DESC) = 1)
SELECT backup_type, folder, extension, db_name, id FROM l QUALIFY row_number() OVER (PARTITION BY backup_type, folder, extension ORDER BY db_name, id) = 1""")
def _(db):
    return cp.latest_paths(backups(db), "db_name", "type", "start_time", "path", "id").select("backup_type", "folder", "extension", "db_name", "id")
