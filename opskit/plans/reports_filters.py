"""Projections, filters and predicates (B)."""

from pyspark.sql import functions as F

from opskit.operators import filters as fl
from opskit.plans import bindings as b
from opskit.plans.registry import report, stamp

E = F.expr


@report("B01_exclude_values", f"""
SELECT wait_type, count(*) AS n, sum(wait_time_ms)::BIGINT AS ms FROM {b.WAIT_STATS}
WHERE wait_type NOT IN ('SLEEP_TASK') GROUP BY 1""")
def _(db):
    return fl.exclude_values(b.wait_stats(db), "wait_type", fl.IGNORABLE_WAITS).groupBy("wait_type").agg(
        F.count("*").alias("n"), F.sum("wait_time_ms").alias("ms"))


@report("B02_between_time", f"""
SELECT event_id, {stamp("ts")} AS ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12'""")
def _(db):
    return fl.between_time(db.events, "ts", b.lit_ts("2024-01-05"), b.lit_ts("2024-01-12")).select("event_id", "ts")


@report("B03_contains", "SELECT doc_id, length(text) AS len FROM documents WHERE contains(text, 'the')")
def _(db):
    return fl.contains(db.documents, "text", "the").select("doc_id", F.length("text").alias("len"))


@report("B04_like_escape", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 's%!_%' ESCAPE '!' OR p_type LIKE 'S%'")
def _(db):
    a = fl.like_escaped(db.part, "p_name", "s%!_%").select("p_partkey", "p_name")
    return a.unionByName(db.part.filter("p_type like 'S%' and not p_name like 's%!_%' escape '!'").select("p_partkey", "p_name"))


@report("B05_like_class", "SELECT p_partkey, p_brand FROM part WHERE regexp_full_match(p_brand, 'Brand#[0-4][0-9]')")
def _(db):
    from opskit.functions.text import like_class
    return db.part.filter(like_class("p_brand", "Brand#[0-4][0-9]")).select("p_partkey", "p_brand")


@report("B06_match_patterns", """
SELECT p_partkey, p_type, p_name FROM part WHERE (lower(p_type) LIKE 'pro%' AND lower(p_name) LIKE '%ring') OR (lower(p_type) LIKE '%all' AND lower(p_name) LIKE 'red%')""")
def _(db):
    rules = [{"p_type": "pro%", "p_name": "%ring"}, {"p_type": "%all", "p_name": "red%"}]
    return fl.match_patterns(db.part, rules).select("p_partkey", "p_type", "p_name")


@report("B07_optional_filters", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def _(db):
    return fl.optional_filters(db.orders, o_orderstatus="F", o_orderpriority=None, o_custkey="").select("o_orderkey")


@report("B08_isin_csv", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view') AND user_id NOT IN (1, 2)")
def _(db):
    return db.events.filter(fl.isin_csv("event_type", "click, view") & fl.isin_csv("user_id", "1,2", negate=True)).select("event_id", "event_type")


@report("B09_active_sessions", f"""
WITH s AS (SELECT *, snapshot * 100 + session_id AS sid, CASE WHEN blocking_session_id IS NOT NULL THEN snapshot * 100 + blocking_session_id END AS bid FROM {b.SESSIONS})
SELECT sid AS session_id, status FROM s WHERE sid IN (SELECT bid FROM s WHERE bid IS NOT NULL) OR coalesce(bid, 0) <> 0
 OR (sid > 50 AND wait_ms % 2 = 0 AND status <> 'sleeping') OR (sid > 50 AND open_tran_count > 0)""")
def _(db):
    s = b.sessions(db).select(
        E("snapshot * 100 + session_id").alias("session_id"), E("snapshot * 100 + blocking_session_id").alias("blocking_session_id"),
        "status", "open_tran_count", E("wait_ms % 2 = 0").alias("has_request"))
    return fl.active_sessions(s).select("session_id", "status")


@report("B10_at_latest", f"SELECT o_orderkey, {stamp('o_orderdate')} AS o_orderdate FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def _(db):
    return fl.at_latest(db.orders, "o_orderdate").select("o_orderkey", "o_orderdate")


@report("B11_null_tests", f"""
SELECT id, owner_user_id IS NULL AS anonymous, coalesce(closed_date, creation_date) = creation_date AS same, owner_user_id IS NOT DISTINCT FROM last_editor_user_id AS self_edit
FROM {b.POSTS} WHERE closed_date IS NULL""")
def _(db):
    return b.posts(db).filter("closed_date is null").select(
        "id", F.col("owner_user_id").isNull().alias("anonymous"), (F.coalesce("closed_date", "creation_date") == F.col("creation_date")).alias("same"),
        F.col("owner_user_id").eqNullSafe(F.col("last_editor_user_id")).alias("self_edit"))


@report("B12_short_text", "SELECT p_partkey, p_name FROM part WHERE length(rtrim(p_name)) < 9")
def _(db):
    return fl.short_text(db.part, "p_name", 9).select("p_partkey", "p_name")


@report("B13_drop_noise", "SELECT doc_id FROM documents WHERE NOT regexp_matches(text, 'license|copyright|[Tt]he ')")
def _(db):
    return fl.drop_noise(db.documents, "text", ["license", "copyright", "[Tt]he "]).select("doc_id")


@report("B14_sample_rows", "SELECT c_custkey FROM customer ORDER BY md5(c_custkey::VARCHAR || '/42'), c_custkey LIMIT 100")
def _(db):
    return fl.sample_rows(db.customer, "c_custkey", 100, 42).select("c_custkey")


@report("B15_computed_columns", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net, (l_quantity * 60)::BIGINT AS seconds FROM lineitem""")
def _(db):
    return db.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.round(E("l_extendedprice * (1 - l_discount)"), 4).alias("net"),
        E("cast(l_quantity * 60 as bigint)").alias("seconds"))


@report("B16_decode", f"""
SELECT job_name, CASE run_status WHEN 0 THEN 'Failed' WHEN 1 THEN 'Succeeded' WHEN 2 THEN 'Retry' WHEN 3 THEN 'Canceled' ELSE 'In Progress' END AS status, count(*) AS n
FROM {b.JOB_HISTORY} GROUP BY 1, 2""")
def _(db):
    return b.job_history(db).groupBy("job_name", fl.decode("run_status", fl.RUN_STATUS, "In Progress").alias("status")).agg(F.count("*").alias("n"))
