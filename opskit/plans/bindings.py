"""The reference's table roles, derived from the given tables, in Spark and in SQL.

Every pair (function, SQL constant) describes the same relation.  All of them are plain
projections or joins of whole tables, so the work of a report grows with its tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

E = F.expr


def lit_ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def minutes_after(start: str, minutes: Column) -> Column:
    return lit_ts(start) + F.make_dt_interval(mins=minutes.cast("int"))


# -- telemetry --------------------------------------------------------------------------


def counters(db) -> DataFrame:
    """Counter samples: one series per (server, counter)."""
    return db.events.select(
        F.col("ts").alias("collection_time"), F.col("user_id").alias("server_id"),
        F.col("event_type").alias("counter_name"), E("cast(round(value * 100) as bigint)").alias("cntr_value"),
        E("cast(get_json_object(props, '$.k') as bigint)").alias("k"), "event_id",
    )


COUNTERS = """(SELECT ts AS collection_time, user_id AS server_id, event_type AS counter_name,
 cast(round(value * 100) AS BIGINT) AS cntr_value, (props->>'$.k')::BIGINT AS k, event_id FROM events)"""

# Wait type shown for each event type.
WAIT_OF = {"click": "SLEEP_TASK", "error": "LCK_M_X", "purchase": "WRITELOG", "signup": "PAGEIOLATCH_SH", "view": "CXPACKET"}
_WAIT_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in WAIT_OF.items()) + " END"
# Wait categories; types that are absent count as Other and not ignorable.
WAIT_CATEGORY = [("LCK_M_X", "Lock", 0), ("WRITELOG", "Log IO", 0), ("SLEEP_TASK", "Idle", 1)]


def wait_stats(db) -> DataFrame:
    """Wait statistics per server and day."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    return (
        db.events.withColumn("k", E("cast(get_json_object(props, '$.k') as bigint)"))
        .groupBy((F.col("user_id") % 10).alias("server_id"), day.alias("check_date"), E(_WAIT_CASE).alias("wait_type"))
        .agg(
            E("sum(cast(round(value * 100) as bigint))").alias("wait_time_ms"),
            E("sum(k)").alias("signal_wait_time_ms"), F.count("*").alias("waiting_tasks_count"),
        )
    )


WAIT_STATS = f"""(SELECT user_id % 10 AS server_id, date_trunc('day', ts)::TIMESTAMP AS check_date, {_WAIT_CASE} AS wait_type,
 sum(cast(round(value * 100) AS BIGINT))::BIGINT AS wait_time_ms, sum((props->>'$.k')::BIGINT)::BIGINT AS signal_wait_time_ms,
 count(*) AS waiting_tasks_count FROM events GROUP BY ALL)"""


# -- sessions ---------------------------------------------------------------------------


def sessions(db) -> DataFrame:
    """Session snapshots: one snapshot per conversation, one session per turn."""
    return db.conversations.select(
        minutes_after("2024-01-01 00:00:00", F.col("conv_id")).alias("collection_time"), F.col("conv_id").alias("snapshot"),
        (F.col("turn") + 51).alias("session_id"),
        E("CASE WHEN turn = 0 THEN NULL WHEN conv_id % 2 = 0 THEN turn + 50 ELSE (turn div 2) + 51 END").alias("blocking_session_id"),
        F.col("role").alias("login_name"), F.concat(F.lit("app"), F.col("conv_id") % 4).alias("program_name"),
        F.concat(F.lit("db"), F.col("turn") % 3).alias("database_name"), F.md5("text").alias("sql_command"),
        (F.length("text") * 100).cast("bigint").alias("wait_ms"), (F.col("turn") % 3).alias("open_tran_count"),
        F.when(F.col("turn") % 4 == 3, "sleeping").otherwise("running").alias("status"),
        (lit_ts("2024-01-01 00:00:00") + F.make_dt_interval(mins=(F.col("conv_id") - F.length("text") % 400).cast("int"))).alias("tran_start_time"),
        (F.length("text") % 60).cast("bigint").alias("minutes"),
    ).withColumn("wait_info", E("CASE WHEN blocking_session_id IS NOT NULL THEN concat('(', wait_ms, 'ms)LCK_M_S') END"))


SESSIONS = """(SELECT TIMESTAMP '2024-01-01' + to_minutes(conv_id) AS collection_time, conv_id AS snapshot, turn + 51 AS session_id,
 CASE WHEN turn = 0 THEN NULL WHEN conv_id % 2 = 0 THEN turn + 50 ELSE turn // 2 + 51 END AS blocking_session_id,
 role AS login_name, 'app' || (conv_id % 4) AS program_name, 'db' || (turn % 3) AS database_name, md5(text) AS sql_command,
 (length(text) * 100)::BIGINT AS wait_ms, turn % 3 AS open_tran_count,
 CASE WHEN turn % 4 = 3 THEN 'sleeping' ELSE 'running' END AS status,
 TIMESTAMP '2024-01-01' + to_minutes(conv_id - length(text) % 400) AS tran_start_time,
 (length(text) % 60)::BIGINT AS minutes FROM conversations)"""


# -- community --------------------------------------------------------------------------


def posts(db) -> DataFrame:
    """Every third order is a question; the two keys after it are its answers."""
    return db.orders.select(
        F.col("o_orderkey").alias("id"), E("CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 2 END").alias("post_type_id"),
        E("CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey - o_orderkey % 3 END").alias("parent_id"),
        E("CASE WHEN o_orderkey % 41 <> 0 THEN o_custkey END").alias("owner_user_id"),
        E("CASE WHEN o_orderkey % 2 = 0 THEN (o_custkey * 7 + o_orderkey) % 100 END").alias("last_editor_user_id"),
        E("CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 THEN o_orderkey + 1 END").alias("accepted_answer_id"),
        E("cast(floor(o_totalprice) as bigint) % 8 - 1").alias("score"),
        E("cast(floor(o_totalprice) as bigint) % 1000").alias("view_count"),
        F.col("o_orderpriority").alias("title"),
        E("CASE WHEN o_orderkey % 4 = 1 THEN 'Thank you' ELSE concat('see http://site', o_custkey % 50, '.example/x') END").alias("body"),
        F.col("o_orderdate").alias("creation_date"), F.col("o_orderdate").alias("last_activity_date"),
        E("CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 = 0 THEN o_orderdate END").alias("closed_date"),
        E("CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate END").alias("community_owned_date"),
    )


POSTS = """(SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 2 END AS post_type_id,
 CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey - o_orderkey % 3 END AS parent_id,
 CASE WHEN o_orderkey % 41 <> 0 THEN o_custkey END AS owner_user_id,
 CASE WHEN o_orderkey % 2 = 0 THEN (o_custkey * 7 + o_orderkey) % 100 END AS last_editor_user_id,
 CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 THEN o_orderkey + 1 END AS accepted_answer_id,
 floor(o_totalprice)::BIGINT % 8 - 1 AS score, floor(o_totalprice)::BIGINT % 1000 AS view_count, o_orderpriority AS title,
 CASE WHEN o_orderkey % 4 = 1 THEN 'Thank you' ELSE 'see http://site' || (o_custkey % 50) || '.example/x' END AS body,
 o_orderdate AS creation_date, o_orderdate AS last_activity_date,
 CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 = 0 THEN o_orderdate END AS closed_date,
 CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate END AS community_owned_date FROM orders)"""


def users(db) -> DataFrame:
    return db.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("display_name"),
        E("cast(floor(c_acctbal) as bigint)").alias("reputation"), E("c_custkey % 300").alias("up_votes"),
        E("c_custkey % 17").alias("down_votes"),
        (lit_ts("1995-01-01 00:00:00") + F.make_dt_interval(days=(F.col("c_custkey") % 700).cast("int"))).alias("creation_date"),
        F.concat(F.lit("NATION_"), "c_nationkey").alias("location"),
        E("concat('http://site', c_custkey, '.example/')").alias("website_url"),
        E("CASE WHEN c_custkey % 9 <> 0 THEN md5(cast(c_custkey div 4 as string)) END").alias("email_hash"),
    )


USERS = """(SELECT c_custkey AS id, c_name AS display_name, floor(c_acctbal)::BIGINT AS reputation, c_custkey % 300 AS up_votes,
 c_custkey % 17 AS down_votes, TIMESTAMP '1995-01-01' + to_days((c_custkey % 700)::INT) AS creation_date,
 'NATION_' || c_nationkey AS location, 'http://site' || c_custkey || '.example/' AS website_url,
 CASE WHEN c_custkey % 9 <> 0 THEN md5((c_custkey // 4)::VARCHAR) END AS email_hash FROM customer)"""


def votes(db) -> DataFrame:
    """Up (2), down (3) and bounty (9) votes."""
    return db.lineitem.select(
        F.col("l_orderkey").alias("post_id"),
        E("CASE l_returnflag WHEN 'A' THEN 2 WHEN 'R' THEN 3 ELSE 9 END").alias("vote_type_id"),
        E("CASE WHEN l_returnflag = 'N' THEN cast(l_quantity as bigint) END").alias("bounty_amount"),
        F.col("l_shipdate").alias("creation_date"),
    )


VOTES = """(SELECT l_orderkey AS post_id, CASE l_returnflag WHEN 'A' THEN 2 WHEN 'R' THEN 3 ELSE 9 END AS vote_type_id,
 CASE WHEN l_returnflag = 'N' THEN l_quantity::BIGINT END AS bounty_amount, l_shipdate AS creation_date FROM lineitem)"""


def tags(db) -> DataFrame:
    return db.part.select(E("cast(substring(p_brand, 7) as bigint)").alias("id"), F.col("p_brand").alias("tag_name")).distinct()


TAGS = "(SELECT DISTINCT substr(p_brand, 7)::BIGINT AS id, p_brand AS tag_name FROM part)"


def post_tags(db) -> DataFrame:
    part = db.part.select(F.col("p_partkey").alias("l_partkey"), E("cast(substring(p_brand, 7) as bigint)").alias("tag_id"))
    return db.lineitem.select(F.col("l_orderkey").alias("post_id"), "l_partkey").join(part, "l_partkey").select("post_id", "tag_id").distinct()


POST_TAGS = """(SELECT DISTINCT l_orderkey AS post_id, substr(p_brand, 7)::BIGINT AS tag_id FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def badges(db) -> DataFrame:
    return db.events.select(F.col("event_id").alias("id"), "user_id", F.col("event_type").alias("name"), F.col("ts").alias("date"))


BADGES = "(SELECT event_id AS id, user_id, event_type AS name, ts AS date FROM events)"


def comments(db) -> DataFrame:
    return db.documents.select(
        F.col("doc_id").alias("id"), (F.col("doc_id") % 150).alias("user_id"), F.col("doc_id").alias("post_id"),
        (F.col("n_chars") % 6).alias("score"), "text",
        (lit_ts("1996-01-01 00:00:00") + F.make_dt_interval(days=(F.col("doc_id") % 365).cast("int"))).alias("creation_date"),
    )


COMMENTS = """(SELECT doc_id AS id, doc_id % 150 AS user_id, doc_id AS post_id, n_chars % 6 AS score, text,
 TIMESTAMP '1996-01-01' + to_days((doc_id % 365)::INT) AS creation_date FROM documents)"""


def post_links(db) -> DataFrame:
    return db.orders.select(
        F.col("o_orderkey").alias("post_id"), (F.col("o_orderkey") - 3).alias("related_post_id"),
        E("CASE WHEN o_orderstatus = 'F' THEN 3 ELSE 1 END").alias("link_type_id"))


POST_LINKS = """(SELECT o_orderkey AS post_id, o_orderkey - 3 AS related_post_id,
 CASE WHEN o_orderstatus = 'F' THEN 3 ELSE 1 END AS link_type_id FROM orders)"""


def post_history(db) -> DataFrame:
    return db.lineitem.select(F.col("l_orderkey").alias("post_id"), E("CASE WHEN l_linestatus = 'F' THEN 10 ELSE 2 END").alias("post_history_type_id"))


POST_HISTORY = "(SELECT l_orderkey AS post_id, CASE WHEN l_linestatus = 'F' THEN 10 ELSE 2 END AS post_history_type_id FROM lineitem)"


# -- jobs, files, inventory -------------------------------------------------------------


def job_history(db) -> DataFrame:
    return db.orders.select(
        E("concat('job', o_custkey % 200)").alias("job_name"), F.col("o_orderkey").alias("instance_id"),
        E("o_orderkey % 3").alias("step_id"), E("CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 3 END").alias("run_status"),
        E("cast(date_format(o_orderdate, 'yyyyMMdd') as bigint)").alias("run_date"),
        E("(o_orderkey % 24) * 10000 + (o_custkey % 60) * 100").alias("run_time"),
        E("(o_custkey % 60) * 10000 + (o_orderkey % 60) * 100 + o_custkey % 60").alias("run_duration"),
    )


JOB_HISTORY = """(SELECT 'job' || (o_custkey % 200) AS job_name, o_orderkey AS instance_id, o_orderkey % 3 AS step_id,
 CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 3 END AS run_status, strftime(o_orderdate, '%Y%m%d')::BIGINT AS run_date,
 (o_orderkey % 24) * 10000 + (o_custkey % 60) * 100 AS run_time,
 (o_custkey % 60) * 10000 + (o_orderkey % 60) * 100 + o_custkey % 60 AS run_duration FROM orders)"""


def files(db) -> DataFrame:
    """Data and log files: one per document, foldered by source and language."""
    return db.documents.select(
        F.col("doc_id").alias("file_id"), F.col("source").alias("db_name"),
        F.concat(F.lit("E:/"), "source", F.lit("/"), "lang", F.lit("/f"), "doc_id", F.when(F.col("doc_id") % 4 == 0, ".ldf").otherwise(".mdf")).alias("path"),
        F.when(F.col("doc_id") % 4 == 0, "LOG").otherwise("ROWS").alias("type_desc"),
        (F.col("n_chars") * 8).alias("size_mb"), F.col("n_chars").alias("used_mb"),
        minutes_after("2024-01-01 00:00:00", F.col("doc_id") % 240).alias("collection_time"),
    )


FILES = """(SELECT doc_id AS file_id, source AS db_name,
 'E:/' || source || '/' || lang || '/f' || doc_id || CASE WHEN doc_id % 4 = 0 THEN '.ldf' ELSE '.mdf' END AS path,
 CASE WHEN doc_id % 4 = 0 THEN 'LOG' ELSE 'ROWS' END AS type_desc, n_chars * 8 AS size_mb, n_chars AS used_mb,
 TIMESTAMP '2024-01-01' + to_minutes(doc_id % 240) AS collection_time FROM documents)"""


def volumes(db) -> DataFrame:
    """One volume per source, plus the drive itself."""
    per = db.documents.groupBy(F.concat(F.lit("E:/"), "source", F.lit("/")).alias("volume")).agg((F.sum("n_chars") * 10).alias("capacity_mb"))
    return per.unionByName(db.documents.agg((F.sum("n_chars") * 20).alias("capacity_mb")).withColumn("volume", F.lit("E:/")))


VOLUMES = """(SELECT 'E:/' || source || '/' AS volume, (sum(n_chars) * 10)::BIGINT AS capacity_mb FROM documents GROUP BY 1
 UNION ALL SELECT 'E:/', (sum(n_chars) * 20)::BIGINT FROM documents)"""


def inventory_target(db) -> DataFrame:
    return db.customer.filter("c_acctbal >= 0").select(
        F.col("c_custkey").alias("server_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("env"), F.col("c_nationkey").cast("bigint").alias("ram"))


INV_TARGET = "(SELECT c_custkey AS server_id, c_name AS name, c_mktsegment AS env, c_nationkey::BIGINT AS ram FROM customer WHERE c_acctbal >= 0)"


def inventory_source(db) -> DataFrame:
    return db.customer.filter("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("server_id"), F.col("c_name").alias("name"),
        E("CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'RETIRED' ELSE c_mktsegment END").alias("env"),
        E("CASE WHEN c_custkey % 11 = 0 THEN c_nationkey + 100 ELSE c_nationkey END").cast("bigint").alias("ram"))


INV_SOURCE = """(SELECT c_custkey AS server_id, c_name AS name,
 CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'RETIRED' ELSE c_mktsegment END AS env,
 (CASE WHEN c_custkey % 11 = 0 THEN c_nationkey + 100 ELSE c_nationkey END)::BIGINT AS ram FROM customer WHERE c_mktsegment <> 'BUILDING')"""


def staging(db) -> DataFrame:
    """Staging rows with duplicates: one per order, keyed by customer."""
    return db.orders.select(
        F.col("o_custkey").alias("server_id"), F.concat(F.lit("db"), F.col("o_orderkey") % 4).alias("database_name"),
        F.col("o_orderdate").alias("collection_time"), F.col("o_orderkey").alias("row_id"), F.col("o_orderstatus").alias("recovery_model"))


STAGING = """(SELECT o_custkey AS server_id, 'db' || (o_orderkey % 4) AS database_name, o_orderdate AS collection_time,
 o_orderkey AS row_id, o_orderstatus AS recovery_model FROM orders)"""


# -- replication tokens -----------------------------------------------------------------


def token_header(db) -> DataFrame:
    return db.orders.select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("pub"), F.col("o_custkey") % 50).alias("publication"),
        F.col("o_orderdate").alias("publisher_commit"), E("o_orderstatus <> 'P' or o_custkey % 50 < 5").alias("is_processed"))


TOKEN_HEADER = """(SELECT o_orderkey AS id, 'pub' || (o_custkey % 50) AS publication, o_orderdate AS publisher_commit,
 o_orderstatus <> 'P' OR o_custkey % 50 < 5 AS is_processed FROM orders)"""


def token_history(db) -> DataFrame:
    """Arrival of each token at the distributor and, hours later, at a subscriber."""
    return db.lineitem.select(
        F.col("l_orderkey").alias("id"), F.concat(F.lit("sub"), F.col("l_suppkey") % 5).alias("subscriber"),
        F.col("l_shipdate").alias("distributor_commit"),
        E("l_shipdate + make_dt_interval(0, cast(l_linenumber as int), cast(l_quantity as int))").alias("subscriber_commit"), "l_partkey")


TOKEN_HISTORY = """(SELECT l_orderkey AS id, 'sub' || (l_suppkey % 5) AS subscriber, l_shipdate AS distributor_commit,
 l_shipdate + to_hours(l_linenumber) + to_minutes(l_quantity::BIGINT) AS subscriber_commit, l_partkey FROM lineitem)"""
