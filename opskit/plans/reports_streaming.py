"""Streaming reports (M): the given tables replayed as files, drained, and read back."""

from pyspark.sql import functions as F

from opskit.plans.registry import report, stamp
from opskit.session import scratch_path
from opskit.streaming import ingest as ing
from opskit.streaming import stateful as st

E = F.expr
CENTS = "cast(round(value * 100) AS BIGINT)"


def replay(db, df, conditions, label, ts, run):
    """Write the rows of each condition as one set of files and ``run`` the stream over it, set by set.

    A set has as many files as the rows had tasks, and is one batch of the stream.
    """
    path = scratch_path(db.spark, label)
    for cond in conditions:
        df.filter(cond).write.mode("append").parquet(path)
        run(ing.file_stream(db.spark, path, df.schema, ts))


def events_replay(db, conditions, run):
    replay(db, db.events.withColumn("cents", E(CENTS)), conditions, "replay", "ts", run)


WEEKS = ["ts < timestamp_ntz'2024-01-08'", "ts >= timestamp_ntz'2024-01-08' and ts < timestamp_ntz'2024-01-15'",
         "ts >= timestamp_ntz'2024-01-15' and ts < timestamp_ntz'2024-01-22'", "ts >= timestamp_ntz'2024-01-22'"]


def out_of(db, conditions, shape, label):
    root = scratch_path(db.spark, label)
    events_replay(db, conditions, lambda s: ing.drain(shape(s), f"{root}/checkpoint", f"{root}/out"))
    return db.spark.read.parquet(f"{root}/out")


def stateful(db, step, label, shape=lambda s: s):
    root = scratch_path(db.spark, label)
    events_replay(db, WEEKS, lambda s: st.run_stateful(shape(s), step, f"{root}/checkpoint", f"{root}/state", f"{root}/out"))
    return db.spark.read.parquet(f"{root}/out")


@report("M01_ingest", "SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS date FROM events")
def _(db):
    root = scratch_path(db.spark, "ingest")
    events_replay(db, WEEKS, lambda s: ing.ingest(s, "ts", f"{root}/checkpoint", f"{root}/table"))
    return db.spark.read.parquet(f"{root}/table").select("event_id", "user_id", F.col("date").cast("date").alias("date"))


@report("M02_ingest_dedup", "SELECT event_id, user_id FROM events")
def _(db):
    sets = ["ts < timestamp_ntz'2024-01-15'", "ts >= timestamp_ntz'2024-01-10'"]
    return out_of(db, sets, lambda s: ing.ingest_dedup(s, ["event_id"], "ts", "30 days"), "dedup").select("event_id", "user_id")


@report("M03_stream_rollup", f"""
SELECT {stamp("bucket")} AS bucket, event_type, sum(c)::BIGINT AS total, count(*) AS samples FROM (SELECT time_bucket(INTERVAL '60 minutes', ts) AS bucket, event_type, {CENTS} AS c FROM events)
WHERE bucket + INTERVAL 60 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 30 MINUTE GROUP BY 1, 2""")
def _(db):
    return out_of(db, WEEKS, lambda s: ing.stream_rollup(s, ["event_type"], "ts", 60, "30 minutes", "cents"), "rollup")


@report("M04_late_counter", """
SELECT 0 AS batch_id, count(*) AS total_rows, 0 AS late_rows FROM events WHERE event_type <> 'signup'
UNION ALL SELECT 1, count(*), count(*) FILTER (ts < (SELECT max(ts) FROM events WHERE event_type <> 'signup') - INTERVAL 1440 MINUTE) FROM events WHERE event_type = 'signup'""")
def _(db):
    root = scratch_path(db.spark, "late")
    sets = ["event_type <> 'signup'", "event_type = 'signup'"]
    events_replay(db, sets, lambda s: ing.late_counter(s, "ts", 1440, f"{root}/checkpoint", f"{root}/metrics"))
    return db.spark.read.parquet(f"{root}/metrics").filter("total_rows > 0").select("batch_id", "total_rows", "late_rows")


@report("M05_stream_delta", f"""
SELECT event_id, CASE WHEN p IS NULL THEN 0 WHEN c < p THEN c ELSE c - p END AS delta, false AS late FROM (SELECT event_id, {CENTS} AS c, lag({CENTS}) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS p FROM events)""")
def _(db):
    step = st.delta_step(["user_id", "event_type"], "ts", "cents", "event_id")
    return stateful(db, step, "delta").select("event_id", "delta", "late")


@report("M06_stream_flapping", """
WITH l AS (SELECT *, value > 10 AS st, lag(value > 10) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events), r AS (SELECT *, CASE WHEN st IS DISTINCT FROM p THEN 1 ELSE 0 END AS ch, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM l)
SELECT user_id, count(*) AS checks, sum(ch) / count(*) AS change_ratio, sum(ch) / count(*) BETWEEN 0.35 AND 0.65 AS is_flapping FROM r WHERE rn <= 12 GROUP BY 1""")
def _(db):
    d = stateful(db, st.flapping_step("user_id", "ts", "status", "event_id"), "flapping", lambda s: s.withColumn("status", F.col("value") > 10))
    last = d.agg(F.max("batch")).scalar()
    return d.filter(F.col("batch") == last).select("user_id", "checks", "change_ratio", "is_flapping")


@report("M07_stream_suppress", f"""
WITH RECURSIVE m AS (SELECT event_type, floor(epoch(ts) / 60)::BIGINT AS m, min(ts) AS t FROM events GROUP BY 1, 2), s AS (
 SELECT event_type, min(m) AS m FROM m GROUP BY 1 UNION ALL SELECT event_type, nxt FROM (SELECT s.event_type, (SELECT min(m.m) FROM m WHERE m.event_type = s.event_type AND m.m >= s.m + 720) AS nxt FROM s) WHERE nxt IS NOT NULL)
SELECT event_type, {stamp('t')} AS ts, false AS late FROM s JOIN m USING (event_type, m)""")
def _(db):
    return stateful(db, st.suppress_step("event_type", "ts", 720), "suppress").select("event_type", "ts", "late")


@report("M08_stream_heartbeat", f"""
WITH g AS (SELECT user_id, ts, CASE WHEN date_diff('microsecond', lag(ts) OVER w, ts) >= 21600000000 THEN 1 ELSE 0 END AS cut FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
 s AS (SELECT user_id, ts, sum(cut) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT user_id, {stamp('min(ts)')} AS first_seen, {stamp('max(ts)')} AS last_seen, count(*) AS messages FROM s GROUP BY user_id, sid HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def _(db):
    return out_of(db, WEEKS, lambda s: ing.stream_heartbeat(s, ["user_id"], "ts", 360, "10 minutes"), "heartbeat")


@report("M09_consume_queue", "SELECT event_type, count(*) AS messages, 4 AS drains FROM events GROUP BY 1")
def _(db):
    root = scratch_path(db.spark, "queue")

    def action(keys, batch_id):
        keys.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{root}/actions/batch={batch_id}")

    events_replay(db, WEEKS, lambda s: ing.consume_queue(s, "event_type", f"{root}/checkpoint", f"{root}/log", action))
    drains = db.spark.read.parquet(f"{root}/actions").groupBy("event_type").agg(F.count("*").alias("drains"))
    return db.spark.read.parquet(f"{root}/log").groupBy("event_type").agg(F.count("*").alias("messages")).join(drains, "event_type")


@report("M10_stream_events", f"""
SELECT 'k' || (props->>'$.k') AS name, {stamp('ts')} AS time FROM events""")
def _(db):
    from opskit.sources.writers import write_xml_events
    path, root = scratch_path(db.spark, "xml-in"), scratch_path(db.spark, "xml-out")
    write_xml_events(db.events.select(
        F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("_name"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("_timestamp"), "event_id"), path)
    stream = ing.xml_stream(db.spark, path, "event", "_name string, _timestamp string, event_id bigint")
    ing.drain(stream, f"{root}/checkpoint", f"{root}/out")
    return db.spark.read.parquet(f"{root}/out").select(F.col("_name").alias("name"), F.to_timestamp_ntz("_timestamp").alias("time"))


@report("M11_stream_token_latency", f"""
WITH s AS (SELECT o_orderkey AS id, o_orderdate AS sent_at FROM orders), a AS (SELECT l_orderkey AS id, l_shipdate AS arrived_at FROM lineitem), w AS (SELECT least((SELECT max(sent_at) FROM s), (SELECT max(arrived_at) FROM a)) - INTERVAL 1 DAY AS wm),
 j AS (SELECT s.id, sent_at, arrived_at FROM s LEFT JOIN a ON a.id = s.id AND arrived_at >= sent_at AND arrived_at <= sent_at + INTERVAL 90 DAY)
SELECT id, {stamp('sent_at')} AS sent_at, {stamp('arrived_at')} AS arrived_at, arrived_at IS NULL AS lost FROM j, w WHERE arrived_at IS NOT NULL OR sent_at + INTERVAL 90 DAY < wm""")
def _(db):
    s = db.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("sent_at"))
    a = db.lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_shipdate").alias("arrived_at"))
    root = scratch_path(db.spark, "tokens")
    s.write.parquet(f"{root}/sent")
    a.write.parquet(f"{root}/arrived")
    sent = ing.file_stream(db.spark, f"{root}/sent", s.schema, "sent_at")
    arrived = ing.file_stream(db.spark, f"{root}/arrived", a.schema, "arrived_at")
    ing.drain(ing.stream_token_latency(sent, arrived, "id", "90 days", "1 day"), f"{root}/checkpoint", f"{root}/out")
    return db.spark.read.parquet(f"{root}/out").select("id", "sent_at", "arrived_at", "lost")
