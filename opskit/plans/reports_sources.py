"""Sources, sinks and helper objects (A, K, N).

File round trips write data derived from the given tables to the shared scratch folder
and read it back.
"""

from pyspark.sql import functions as F

from opskit.functions import clock, text
from opskit.operators import aggregates as ag
from opskit.operators import alerts as al
from opskit.operators import reshape as rs
from opskit.plans import bindings as b
from opskit.plans.registry import TS_TEXT, report, stamp
from opskit.plans.reports_events import EV, event_xml
from opskit.session import scratch_path
from opskit.sources import readers as rd
from opskit.sources import writers as wr

E = F.expr


@report("A01_read_metric", f"SELECT event_id, {stamp('ts')} AS ts, value FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-11 12:00:00'")
def _(db):
    return rd.read_metric(db.spark, db.path("events"), "ts", b.lit_ts("2024-01-10"), b.lit_ts("2024-01-11 12:00:00")).select("event_id", "ts", "value")


@report("A02_counter_log", "SELECT event_id, c_name AS counter_name, n_name AS display, value FROM events JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = user_id % 25")
def _(db):
    data = db.events.select("event_id", F.col("user_id").alias("counter_id"), (F.col("user_id") % 25).alias("guid"), "value")
    details = db.customer.select(F.col("c_custkey").alias("counter_id"), F.col("c_name").alias("counter_name"))
    display = db.nation.select(F.col("n_nationkey").cast("bigint").alias("guid"), F.col("n_name").alias("display"))
    return rd.read_counter_log(data, details, display).select("event_id", "counter_name", "display", "value")


@report("A03_xml_event_files", f"""
SELECT CASE event_type WHEN 'error' THEN 'error_reported' WHEN 'signup' THEN 'availability_replica_state_change' ELSE 'sql_batch_completed' END AS event_name, {stamp('ts')} AS time, client_app_name, (SELECT count(*) FROM events) AS last_no FROM {EV}""")
def _(db):
    from opskit.operators.events import EVENT_SCHEMA, parse
    path = scratch_path(db.spark, "events-xml")
    wr.write_xml_events(parse(event_xml(db), "xml", EVENT_SCHEMA).select("doc.*"), path)
    d = rd.read_xml_events(db.spark, path, "event", EVENT_SCHEMA, columns=["_name", "_timestamp", "action"])
    app = F.get(F.filter("action", lambda a: a["_name"] == "client_app_name"), F.lit(0))["value"]
    return d.select(F.col("_name").alias("event_name"), F.to_timestamp_ntz("_timestamp").alias("time"), app.alias("client_app_name"),
                    F.lit(d.agg(F.max("event_no")).scalar()).alias("last_no"))


@report("A04_read_log", f"""
SELECT {stamp("date_trunc('millisecond', ts)")} AS log_date, 'spid' || user_id AS process, 'Error: ' || event_type || ' state ' || (props->>'$.k') || chr(10) || '    user ' || user_id || chr(10) || '2nd detail' AS text FROM events
WHERE event_type = 'error' AND contains(' state ' || (props->>'$.k'), 'state 7') AND date_trunc('millisecond', ts) BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-28'""")
def _(db):
    path = scratch_path(db.spark, "logs")
    line = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), F.lit("  spid"), "user_id", F.lit("    Error: "), "event_type", F.lit(" state "), F.get_json_object("props", "$.k"))
    detail = F.concat(F.lit("\n    user "), "user_id", F.lit("\n2nd detail"))
    db.events.select(F.concat(line, detail).alias("value")).write.text(path)
    return rd.read_log(db.spark, path, ["error", "state 7"], b.lit_ts("2024-01-03"), b.lit_ts("2024-01-28"))


@report("A05_list_files")
def _(db):
    return rd.list_files(db.spark, db.dir).select("name", "size_bytes", "depth")


@report("A06_parse_delimited", "SELECT c_custkey, c_name AS name, c_mktsegment AS label, c_nationkey::BIGINT AS capacity, c_acctbal AS free FROM customer WHERE c_mktsegment <> 'BUILDING'")
def _(db):
    d = db.customer.select("c_custkey", F.concat_ws("|", "c_name", "c_mktsegment", F.concat(F.lit(" "), "c_nationkey"), "c_acctbal").alias("line"))
    return rd.parse_delimited(d, "line", "|", {"name": "string", "label": "string", "capacity": "bigint", "free": "double"}, r"^Customer#\d+\|(?!BUILDING)")


@report("A07_union_sources", "SELECT c_custkey AS k, c_acctbal AS bal, 'customers' AS source_name FROM customer UNION ALL SELECT s_suppkey, s_acctbal, 'suppliers' FROM supplier")
def _(db):
    return ag.union_sources({"customers": db.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal")),
                             "suppliers": db.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("bal"))})


@report("A08_fan_out", """
SELECT 'orders' AS source_name, count(*) AS n, 'ok' AS state FROM orders UNION ALL SELECT 'lineitem', count(*), 'ok' FROM lineitem UNION ALL SELECT 'missing_table', NULL, 'failed' UNION ALL SELECT 'broken_file', NULL, 'failed'""")
def _(db):
    broken = scratch_path(db.spark, "broken")
    db.supplier.limit(3).select("s_name").coalesce(1).write.text(broken)  # no Parquet: fails when it is read
    sources = {t: db.path(t) for t in ("orders", "lineitem", "missing_table")} | {"broken_file": broken}
    good, bad = rd.fan_out(db.spark, sources, lambda p: db.spark.read.schema("comment string").parquet(p).agg(F.count("*").alias("n")))
    return good.withColumn("state", F.lit("ok")).unionByName(bad.select("source_name", F.lit(None).cast("bigint").alias("n"), F.lit("failed").alias("state")))


@report("A09_values", "SELECT v.label, count(*) AS n FROM orders JOIN (VALUES ('F', 'failed'), ('O', 'open'), ('P', 'pending')) v(code, label) ON o_orderstatus = code GROUP BY 1")
def _(db):
    v = rd.values_df(db.spark, [("F", "failed"), ("O", "open"), ("P", "pending")], "code string, label string")
    return db.orders.join(F.broadcast(v), E("o_orderstatus = code")).groupBy("label").agg(F.count("*").alias("n"))


@report("A10_time_dimension", f"""
WITH r AS (SELECT time_bucket(INTERVAL '10 minutes', min(ts)) AS a, time_bucket(INTERVAL '10 minutes', max(ts)) AS z FROM events), d AS (SELECT unnest(generate_series(a, z, INTERVAL 10 MINUTE)) AS time FROM r)
SELECT {stamp('d.time')} AS time, count(event_id) AS n FROM d LEFT JOIN events ON time_bucket(INTERVAL '10 minutes', ts) = d.time GROUP BY 1""")
def _(db):
    bucket = clock.time_bucket("ts", 10).cast("timestamp_ntz")
    edge = db.events.agg(F.min(bucket).alias("a"), F.max(bucket).alias("z")).first()
    n = db.events.groupBy(bucket.alias("time")).agg(F.count("*").alias("n"))
    return rd.time_dimension(db.spark, edge["a"], edge["z"], 600).join(n, "time", "left").select("time", F.coalesce("n", F.lit(0)).alias("n"))


@report("A11_numbers", "SELECT n FROM range(1, (SELECT count(*) FROM orders) + 1) t(n) WHERE n NOT IN (SELECT l_orderkey FROM lineitem)")
def _(db):
    return rd.numbers(db.spark, db.orders.count()).join(db.lineitem.select(F.col("l_orderkey").alias("n")), "n", "left_anti")


@report("A12_read_trace", "SELECT 'stmt \"' || l_partkey || '\",' || chr(10) || ' x' AS statement, l_linenumber::BIGINT AS executions, l_quantity::BIGINT AS cpu, l_orderkey AS reads, l_suppkey AS writes, l_orderkey AS duration, 41 AS event_class FROM lineitem")
def _(db):
    path = scratch_path(db.spark, "trace")
    wr.write_csv(db.lineitem.select(
        F.concat(F.lit('stmt "'), "l_partkey", F.lit('",\n x')).alias("statement"), F.col("l_linenumber").alias("executions"), F.col("l_quantity").cast("bigint").alias("cpu"), F.col("l_orderkey").alias("reads"),
        F.col("l_suppkey").alias("writes"), F.col("l_orderkey").alias("duration"), F.lit(41).alias("event_class")), path)
    return rd.read_trace(db.spark, path)


@report("A13_cpu_ring", f"""
SELECT event_id, event_id AS record_id, {stamp("TIMESTAMP '2024-01-31' - to_milliseconds(event_id * 1000)")} AS event_time, 100 - k % 100 AS system_cpu, k % 50 AS process_cpu FROM {EV}""")
def _(db):
    k = E("cast(get_json_object(props, '$.k') as bigint)")
    tag = E("CASE WHEN event_id % 2 = 0 THEN 'SchedulerMonitorEvent' ELSE 'SchedluerMonitorEvent' END")
    rec = F.concat(F.lit('<Record id="'), "event_id", F.lit('"><'), tag, F.lit("><SystemHealth><ProcessUtilization>"), k % 50, F.lit("</ProcessUtilization><SystemIdle>"), k % 100,
                   F.lit("</SystemIdle></SystemHealth></"), tag, F.lit("></Record>"))
    d = db.events.select("event_id", rec.alias("record"), (F.lit(10**9) - F.col("event_id") * 1000).alias("stamp_ms"), F.lit(10**9).alias("now_ms"))
    return rd.parse_cpu_ring(d, "record", "stamp_ms", "now_ms", b.lit_ts("2024-01-31 00:00:00")).select("event_id", "record_id", "event_time", "system_cpu", "process_cpu")


# -- sinks ------------------------------------------------------------------------------


@report("K01_append_samples", "SELECT user_id, value, CASE WHEN event_type = 'click' THEN '2024-02-01' ELSE '2024-02-02' END AS date FROM events")
def _(db):
    path = scratch_path(db.spark, "samples")
    for part, at in (("=", "2024-02-01 06:00:00"), ("<>", "2024-02-02 06:00:00")):
        wr.append_samples(db.events.filter(f"event_type {part} 'click'").select("user_id", "value"), path, b.lit_ts(at))
    return db.spark.read.parquet(path).select("user_id", "value", F.col("date").cast("date").alias("date"))


@report("K02_append_new", "SELECT event_id, event_type FROM events")
def _(db):
    path = scratch_path(db.spark, "append-new")
    for cond in ("event_type in ('click', 'error')", "event_type <> 'click'", "event_type = 'view'"):
        wr.append_new(db.events.filter(cond).select("event_id", "event_type"), path, ["event_id"])
    return db.spark.read.parquet(path)


@report("K03_overwrite_latest", "SELECT user_id, arg_max(event_id, ts) AS event_id FROM events GROUP BY 1")
def _(db):
    path = scratch_path(db.spark, "latest")
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    wr.overwrite_latest(db.events.filter("ts < timestamp_ntz'2024-01-10'"), path, ["user_id"], order)
    wr.overwrite_latest(db.events, path, ["user_id"], order)
    return db.spark.read.parquet(path).select("user_id", "event_id")


@report("K04_archive_and_clear", "SELECT o_custkey, 'history' AS zone FROM orders")
def _(db):
    root = scratch_path(db.spark, "archive")
    staging, history = f"{root}/staging", f"{root}/history"
    for status in ("F", "O", "P"):
        db.orders.filter(F.col("o_orderstatus") == status).select("o_custkey").write.mode("append").parquet(staging)
        wr.archive_and_clear(db.spark, staging, history)
    read = lambda p, z: db.spark.read.parquet(p).select("o_custkey", F.lit(z).alias("zone"))
    return read(history, "history").unionByName(read(staging, "staging"))


@report("K05_merge_full", f"""
SELECT coalesce(s.server_id, t.server_id) AS server_id, CASE WHEN s.server_id IS NULL THEN t.env ELSE s.env END AS env, CASE WHEN s.server_id IS NULL THEN t.ram ELSE s.ram END AS ram,
 CASE WHEN t.server_id IS NULL THEN 'insert' WHEN s.server_id IS NULL THEN 'delete' WHEN s.env IS DISTINCT FROM t.env OR s.ram IS DISTINCT FROM t.ram THEN 'update' ELSE 'keep' END AS action
FROM {b.INV_SOURCE} s FULL JOIN {b.INV_TARGET} t ON s.server_id = t.server_id""")
def _(db):
    return wr.merge_full(b.inventory_target(db), b.inventory_source(db), ["server_id"], ["env", "ram"])


@report("K06_upsert_changed", f"""
SELECT t.server_id, t.name, coalesce(s.env, t.env) AS env, coalesce(s.ram, t.ram) AS ram, CASE WHEN (s.env IS NOT NULL AND s.env <> t.env) OR (s.ram IS NOT NULL AND s.ram <> t.ram) THEN '2024-01-31 00:00:00.000000' END AS updated_at
FROM {b.INV_TARGET} t LEFT JOIN {b.INV_SOURCE} s ON s.server_id = t.server_id""")
def _(db):
    return wr.upsert_changed(b.inventory_target(db), b.inventory_source(db), "server_id", ["env", "ram"], b.lit_ts("2024-01-31 00:00:00"))


@report("K07_insert_missing", f"""
SELECT server_id, database_name, row_id FROM {b.STAGING} WHERE server_id NOT IN (SELECT server_id FROM {b.INV_TARGET}) QUALIFY row_number() OVER (PARTITION BY server_id ORDER BY row_id) = 1""")
def _(db):
    return wr.insert_missing(b.inventory_target(db), b.staging(db), ["server_id"], ["row_id"]).select("server_id", "database_name", "row_id")


@report("K08_load_batch", f"""
WITH s AS {b.STAGING}, t AS (SELECT *, year(collection_time) - 1994 AS batch_number FROM s WHERE collection_time < TIMESTAMP '2000-01-01'), n AS (SELECT server_id, database_name, max(collection_time) AS newest FROM t GROUP BY 1, 2)
SELECT server_id, database_name, row_id, (SELECT max(batch_number) + 1 FROM t) AS batch_number FROM s LEFT JOIN n USING (server_id, database_name) WHERE collection_time >= TIMESTAMP '2000-01-01' AND (newest IS NULL OR date_diff('minute', newest, collection_time) >= 2)
QUALIFY row_number() OVER (PARTITION BY server_id, database_name, collection_time ORDER BY row_id) = 1""")
def _(db):
    s = b.staging(db)
    target = s.filter("collection_time < timestamp_ntz'2000-01-01'").withColumn("batch_number", F.year("collection_time") - 1994)
    return wr.load_batch(target, s.filter("collection_time >= timestamp_ntz'2000-01-01'"), ["server_id", "database_name"], "collection_time", "row_id").select("server_id", "database_name", "row_id", "batch_number")


@report("K09_drop_matched", f"SELECT row_id FROM {b.STAGING} WHERE server_id NOT IN (SELECT server_id FROM {b.INV_TARGET})")
def _(db):
    return wr.drop_matched(b.staging(db), b.inventory_target(db), ["server_id"]).select("row_id")


@report("K10_purge", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-15'")
def _(db):
    path = scratch_path(db.spark, "purge")
    db.events.withColumn("date", F.to_date("ts")).repartition("date", F.col("event_id") % 16).write.partitionBy("date").parquet(path)
    wr.purge(db.spark, path, "2024-01-15")
    return db.spark.read.parquet(path).select("event_id")


@report("K11_write_csv", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def _(db):
    path = scratch_path(db.spark, "csv")
    wr.write_csv(db.supplier.select("s_suppkey", "s_name", "s_acctbal"), path)
    return db.spark.read.csv(path, header=True, schema="s_suppkey bigint, s_name string, s_acctbal double")


@report("K12_html_table", """
SELECT '<table><tr><th>o_orderkey</th><th>o_custkey</th></tr>' || string_agg('<tr><td>' || o_orderkey || '</td><td>' || coalesce(o_custkey::VARCHAR, '') || '</td></tr>', '' ORDER BY rn) || '</table>' AS html
FROM (SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN o_custkey END AS o_custkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 50""")
def _(db):
    d = db.orders.withColumn("o_custkey", E("CASE WHEN o_custkey % 2 = 0 THEN o_custkey END"))
    return rs.html_table(d, ["o_orderkey", "o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 50)


@report("K12_html_rows", "SELECT s_suppkey, '<tr><td>' || s_name || '</td><td>' || s_nationkey || '</td></tr>' AS html FROM supplier")
def _(db):
    return rs.html_rows(db.supplier, ["s_name", "s_nationkey"]).select("s_suppkey", "html")


@report("K13_nest", """
SELECT o_custkey, '<customer o_custkey="' || o_custkey || '">' || chr(10) || string_agg('  <order o_orderkey="' || o_orderkey || '" o_orderstatus="' || o_orderstatus || '"/>', chr(10) ORDER BY o_orderkey) || chr(10) || '</customer>' AS document
FROM orders GROUP BY 1""")
def _(db):
    path = scratch_path(db.spark, "documents")
    wr.write_documents(db.orders, path, ["o_custkey"], ["o_orderkey", "o_orderstatus"], "customer", "order")
    return rd.read_documents(db.spark, path, "customer").select(
        F.regexp_extract("text", 'o_custkey="(\\d+)"', 1).cast("bigint").alias("o_custkey"), F.col("text").alias("document"))


@report("K14_enlarge", f"""
WITH c AS (SELECT unnest([1, 2]) AS copy), m AS (SELECT max(o_orderkey) + 1 AS stride FROM orders)
SELECT 'header' AS kind, o_orderkey + stride * copy AS k, copy::BIGINT AS copy, {stamp("o_orderdate + to_days(floor(('0x' || substr(md5(o_orderkey || ':' || copy || '/9'), 1, 8))::BIGINT / 4294967296.0 * 365)::INT)")} AS at FROM orders, c, m
UNION ALL SELECT 'detail', l_orderkey + stride * copy, copy, NULL FROM lineitem, c, m WHERE l_orderkey IN (SELECT o_orderkey FROM orders)""")
def _(db):
    h, d = wr.enlarge(db.orders, db.lineitem, "o_orderkey", "l_orderkey", "o_orderdate", 2, 9)
    return h.select(F.lit("header").alias("kind"), F.col("o_orderkey").alias("k"), "copy", F.date_format("o_orderdate", TS_TEXT).alias("at")).unionByName(
        d.select(F.lit("detail").alias("kind"), F.col("l_orderkey").alias("k"), "copy", F.lit(None).cast("string").alias("at")))


@report("K15_dummy_rows", "SELECT o_orderkey, substr(repeat(md5(o_orderkey || '/3'), 4), 1, 100) AS filler FROM orders WHERE o_orderkey < (SELECT count(*) FROM orders)")
def _(db):
    rows = wr.dummy_rows(db.spark, db.orders.count(), 100, 3).withColumnRenamed("id", "o_orderkey")
    return db.orders.select("o_orderkey").join(rows, "o_orderkey")


@report("K16_reuse", """
WITH u AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1) SELECT 'top' AS kind, max(n) AS n FROM u UNION ALL SELECT 'users', count(*) FROM u""")
def _(db):
    u = wr.reused(db.events.groupBy("user_id").agg(F.count("*").alias("n")))
    return u.agg(F.max("n").alias("n")).withColumn("kind", F.lit("top")).unionByName(u.agg(F.count("*").alias("n")).withColumn("kind", F.lit("users")))


# -- functions and views ----------------------------------------------------------------


@report("N01_votes_of_user", f"SELECT u.id, count(v.post_id) AS votes FROM {b.USERS} u LEFT JOIN {b.POSTS} p ON p.owner_user_id = u.id LEFT JOIN {b.VOTES} v ON v.post_id = p.id GROUP BY 1")
def _(db):
    n = b.votes(db).groupBy("post_id").agg(F.count("*").alias("n"))
    per = b.posts(db).join(n, E("id = post_id")).groupBy(F.col("owner_user_id").alias("id")).agg(F.sum("n").alias("n"))
    return b.users(db).join(per, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("votes"))


@report("N02_next_collection", f"SELECT event_type, {stamp('min(ts)')} AS next_time FROM events WHERE ts >= TIMESTAMP '2024-01-15 12:00:00' GROUP BY 1")
def _(db):
    return db.events.filter(F.col("ts") >= b.lit_ts("2024-01-15 12:00:00")).groupBy("event_type").agg(F.min("ts").alias("next_time"))


@report("N03_name_lookup", "SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def _(db):
    from opskit.operators.joins import denormalise
    names = db.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return denormalise(db.orders, {"o_custkey": names}).select("o_orderkey", "c_name")


@report("N04_job_running", "SELECT DISTINCT o_custkey AS job_id FROM orders WHERE o_orderstatus = 'P'")
def _(db):
    open_runs = db.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("job_id"))
    return db.customer.select(F.col("c_custkey").alias("job_id")).join(open_runs, "job_id", "left_semi")


@report("N05_classify", """
SELECT c_custkey, CASE WHEN lower(c_name) LIKE '%1' THEN 'reporting' WHEN lower(c_mktsegment) LIKE 'b%' AND lower(c_name) LIKE '%2' THEN 'batch' ELSE 'default' END AS pool FROM customer""")
def _(db):
    from opskit.operators.jobs import classify
    rules = [("reporting", {"c_name": "%1"}), ("batch", {"c_mktsegment": "b%", "c_name": "%2"})]
    return db.customer.select("c_custkey", classify(rules, "default").alias("pool"))


@report("N06_binary_hex", "SELECT p_partkey, '0x' || upper(md5(p_name)) AS id FROM part")
def _(db):
    return db.part.select("p_partkey", text.hex0x(F.unhex(F.md5("p_name"))).alias("id"))


@report("N07_time_conversion", f"SELECT event_id, {stamp('ts + INTERVAL 330 MINUTE')} AS local_time FROM events")
def _(db):
    return db.events.select("event_id", clock.to_local("ts", "+05:30").alias("local_time"))


@report("N08_parametrised_report", "SELECT event_type, count(*) AS n, max(value) AS top FROM events WHERE value > 10 AND user_id < 100 GROUP BY 1")
def _(db):
    return db.spark.sql(
        "SELECT event_type, count(*) AS n, max(value) AS top FROM {e} WHERE value > :low AND user_id < :users GROUP BY event_type",
        args={"low": 10, "users": 100}, e=db.events)


@report("N09_view", f"SELECT publication, count(*) FILTER (is_processed) AS done, count(*) AS n FROM {b.TOKEN_HEADER} GROUP BY 1")
def _(db):
    al.close_lost(b.token_header(db)).createOrReplaceTempView("opskit_tokens")
    return db.spark.sql("SELECT publication, count_if(is_processed AND NOT lost) AS done, count(*) AS n FROM opskit_tokens GROUP BY publication")
