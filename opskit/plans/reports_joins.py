"""Joins (C)."""

from pyspark.sql import functions as F

from opskit.operators import joins as jn
from opskit.operators import sessions as ss
from opskit.operators.ordered import null_safe_join, series_lag, series_running_sum
from opskit.plans import bindings as b
from opskit.plans.registry import report, stamp

E = F.expr


@report("C01_inner_chain", f"""
SELECT t.tag_name, count(*) AS up FROM {b.TAGS} t JOIN {b.POST_TAGS} pt ON pt.tag_id = t.id JOIN {b.POSTS} p ON p.parent_id = pt.post_id
JOIN {b.VOTES} v ON v.post_id = p.id AND v.vote_type_id = 2 GROUP BY 1""")
def _(db):
    up = b.votes(db).filter("vote_type_id = 2").groupBy("post_id").agg(F.count("*").alias("n"))
    answers = b.posts(db).filter("parent_id is not null").join(up, E("id = post_id")).groupBy("parent_id").agg(F.sum("n").alias("n"))
    per_tag = b.post_tags(db).join(answers, E("post_id = parent_id")).groupBy("tag_id").agg(F.sum("n").alias("up"))
    return b.tags(db).join(per_tag, E("id = tag_id")).select("tag_name", "up")


@report("C02_implicit_join", "SELECT n_name, r_name, count(*) AS n FROM nation, region, customer WHERE n_regionkey = r_regionkey AND c_nationkey = n_nationkey GROUP BY 1, 2")
def _(db):
    n = db.customer.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return n.join(db.nation, E("c_nationkey = n_nationkey")).join(db.region, E("n_regionkey = r_regionkey")).select("n_name", "r_name", "n")


@report("C03_left_join", """
SELECT c_custkey, count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P' GROUP BY 1""")
def _(db):
    o = db.orders.filter("o_orderstatus = 'P'").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    return db.customer.join(o, E("o_custkey = c_custkey"), "left").select("c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"))


@report("C04_right_join", """
SELECT d.doc_id, l.quality::BIGINT AS quality FROM labels l RIGHT JOIN documents d ON d.doc_id = l.doc_id""")
def _(db):
    return db.labels.join(db.documents.select("doc_id"), "doc_id", "right").select("doc_id", "quality")


SIDES = """
a AS (SELECT event_type, user_id, count(*) AS n, sum(cast(round(value*100) AS BIGINT))::BIGINT AS cents FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY 1, 2),
b AS (SELECT event_type, user_id, count(*) AS n, sum(cast(round(value*100) AS BIGINT))::BIGINT AS cents FROM events WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY 1, 2)"""


def _side(db, cond):
    return db.events.filter(cond).groupBy("event_type", "user_id").agg(F.count("*").alias("n"), E("sum(cast(round(value*100) as bigint))").alias("cents"))


@report("C05_compare_sides", f"""
WITH {SIDES} SELECT event_type, user_id, coalesce(a.n, 0) AS n_a, coalesce(b.n, 0) AS n_b, coalesce(b.n, 0) - coalesce(a.n, 0) AS n_diff,
 coalesce(a.cents, 0) AS cents_a, coalesce(b.cents, 0) AS cents_b, coalesce(b.cents, 0) - coalesce(a.cents, 0) AS cents_diff
FROM a FULL JOIN b USING (event_type, user_id)""")
def _(db):
    return jn.compare_sides(_side(db, "ts < timestamp_ntz'2024-01-10'"), _side(db, "ts >= timestamp_ntz'2024-01-20'"), ["event_type", "user_id"], ["n", "cents"])


@report("C06_attach_scalar", """
SELECT s_suppkey, (SELECT max(n_name) FROM nation WHERE n_nationkey < 0) AS missing, (SELECT count(*) FROM lineitem) AS lines FROM supplier""")
def _(db):
    empty = db.nation.filter("n_nationkey < 0").select(F.col("n_name").alias("missing"))
    return jn.attach_scalar(jn.attach_scalar(db.supplier, empty), db.lineitem.agg(F.count("*").alias("lines"))).select("s_suppkey", "missing", "lines")


@report("C07_scalar_row", """
SELECT o_orderkey, date_diff('day', o_orderdate, (SELECT max(o_orderdate) FROM orders)) AS age FROM orders""")
def _(db):
    last = db.orders.agg(F.max("o_orderdate").alias("last"))
    return jn.attach_scalar(db.orders, last).select("o_orderkey", F.datediff("last", "o_orderdate").alias("age"))


@report("C08_apply_having", """
SELECT p_brand, a.n FROM (SELECT DISTINCT p_brand FROM part) p JOIN (SELECT p_brand, count(*) AS n FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY 1 HAVING count(*) >= 2300) a USING (p_brand)""")
def _(db):
    per_part = db.lineitem.groupBy("l_partkey").agg(F.count("*").alias("n"))
    return db.part.join(per_part, E("l_partkey = p_partkey")).groupBy("p_brand").agg(F.sum("n").alias("n")).filter("n >= 2300")


@report("C09_outer_apply", """
SELECT p_partkey, coalesce(max(l_quantity), 0) AS biggest, count(l_orderkey) AS lines FROM part LEFT JOIN lineitem ON l_partkey = p_partkey AND l_quantity > 49 GROUP BY 1""")
def _(db):
    agg = db.lineitem.filter("l_quantity > 49").groupBy("l_partkey").agg(F.max("l_quantity").alias("biggest"), F.count("*").alias("lines"))
    return db.part.join(agg, E("l_partkey = p_partkey"), "left").select(
        "p_partkey", F.coalesce("biggest", F.lit(0.0)).alias("biggest"), F.coalesce("lines", F.lit(0)).alias("lines"))


@report("C10_let_binding", """
SELECT event_id, a, b, a + b AS c FROM (SELECT *, a * 2 AS b FROM (SELECT event_id, (props->>'$.k')::BIGINT AS a FROM events))""")
def _(db):
    d = db.events.withColumn("a", E("cast(get_json_object(props, '$.k') as bigint)")).withColumn("b", E("a * 2"))
    return d.select("event_id", "a", "b", E("a + b").alias("c"))


LR = """l AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'error'), r AS (SELECT user_id, event_id AS r_id, ts AS r_ts FROM events WHERE event_type = 'signup')"""


def _lr(db):
    left = db.events.filter("event_type = 'error'").select("user_id", "event_id", "ts")
    right = db.events.filter("event_type = 'signup'").select("user_id", F.col("event_id").alias("r_id"), F.col("ts").alias("r_ts"))
    return left, right


@report("C11_asof_backward", f"WITH {LR} SELECT l.user_id, event_id, r_id, {stamp('r_ts')} AS r_ts FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.r_ts")
def _(db):
    left, right = _lr(db)
    return jn.asof_join(left, right, ["user_id"], "ts", "r_ts", ["r_id", "r_ts"], tie="r_id").select("user_id", "event_id", "r_id", "r_ts")


@report("C12_asof_forward", f"WITH {LR} SELECT l.user_id, event_id, r_id, {stamp('r_ts')} AS r_ts FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts <= r.r_ts")
def _(db):
    left, right = _lr(db)
    return jn.asof_join(left, right, ["user_id"], "ts", "r_ts", ["r_id", "r_ts"], "forward", tie="r_id").select("user_id", "event_id", "r_id", "r_ts")


@report("C13_nearest_bounds", f"""
SELECT event_type, {stamp("min(CASE WHEN ts >= TIMESTAMP '2024-01-10' THEN ts END)")} AS lower_time,
 {stamp("max(CASE WHEN ts <= TIMESTAMP '2024-01-20' THEN ts END)")} AS upper_time FROM events GROUP BY 1""")
def _(db):
    return jn.bounds(db.events, "ts", b.lit_ts("2024-01-10"), b.lit_ts("2024-01-20"), ["event_type"])


PTS = "pts AS (SELECT DISTINCT user_id, ts FROM events WHERE event_type = 'signup')"
RNG = """rng AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS range_id, ts AS lower, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS upper FROM pts),
 rs AS (SELECT *, range_id = max(range_id) OVER (PARTITION BY user_id) AS is_last FROM rng WHERE upper IS NOT NULL)"""


def _ranges(db):
    return jn.to_ranges(db.events.filter("event_type = 'signup'").select("user_id", "ts"), "ts", ["user_id"])


@report("C14_interval_join", f"""
WITH {PTS}, {RNG} SELECT e.event_id, rs.range_id FROM events e JOIN rs ON e.user_id = rs.user_id AND e.ts >= rs.lower AND (e.ts < rs.upper OR (rs.is_last AND e.ts = rs.upper))""")
def _(db):
    return jn.range_join(db.events.select("user_id", "event_id", "ts"), _ranges(db), ["user_id"], "ts").select("event_id", "range_id")


@report("C15_running_sum", """
SELECT event_id, sum(cast(round(value*100) AS BIGINT)) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id)::BIGINT AS running FROM events""")
def _(db):
    return series_running_sum(b.counters(db), ["server_id", "counter_name"], ["collection_time", "event_id"], "cntr_value", "running").select("event_id", "running")


@report("C16_adjacent_row", """
SELECT event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_event_id FROM events""")
def _(db):
    return series_lag(db.events.select("user_id", "ts", "event_id"), ["user_id"], ["ts", "event_id"], ["event_id"]).select("event_id", "prev_event_id")


@report("C17_points_to_ranges", f"""
WITH {PTS}, {RNG} SELECT user_id, range_id, {stamp('lower')} AS lower, {stamp('upper')} AS upper, is_last FROM rs""")
def _(db):
    return _ranges(db)


@report("C18_parent_child", f"SELECT q.id, count(*) AS answers, max(a.score) AS best FROM {b.POSTS} q JOIN {b.POSTS} a ON a.parent_id = q.id GROUP BY 1")
def _(db):
    p = b.posts(db)
    a = p.groupBy("parent_id").agg(F.count("*").alias("answers"), F.max("score").alias("best"))
    return p.select("id").join(a, E("id = parent_id")).select("id", "answers", "best")


@report("C19_head_to_head", f"""
WITH a AS (SELECT *, owner_user_id % 10 AS team FROM {b.POSTS} WHERE post_type_id = 2)
SELECT m.parent_id, m.score AS my_score, r.score AS rival_score, CASE WHEN m.score > r.score THEN 'You win' WHEN m.score < r.score THEN 'Rival wins' ELSE 'Tie' END AS winner
FROM a m JOIN a r ON m.parent_id = r.parent_id AND r.team = 2 WHERE m.team = 1""")
def _(db):
    a = b.posts(db).filter("post_type_id = 2").withColumn("team", E("owner_user_id % 10"))
    return jn.head_to_head(a, "parent_id", "team", "score", 1, 2).select("parent_id", "my_score", "rival_score", "winner")


@report("C20_semi", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase')")
def _(db):
    buyers = db.events.filter("event_type = 'purchase'").select(F.col("user_id").alias("c_custkey"))
    return db.customer.join(buyers, "c_custkey", "left_semi").select("c_custkey")


@report("C21_anti", "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def _(db):
    return db.documents.join(db.labels, "doc_id", "left_anti").select("doc_id")


@report("C22_null_aware_anti", f"""
SELECT 'clean list' AS kind, id FROM {b.USERS} WHERE id NOT IN (SELECT owner_user_id FROM {b.POSTS} WHERE owner_user_id IS NOT NULL AND closed_date IS NOT NULL)
UNION ALL SELECT 'list with null', id FROM {b.USERS} WHERE id NOT IN (SELECT owner_user_id FROM {b.POSTS} WHERE closed_date IS NOT NULL)""")
def _(db):
    closed = b.posts(db).filter("closed_date is not null").select("owner_user_id")
    u = b.users(db).select("id")
    clean = jn.not_in(u, "id", closed.filter("owner_user_id is not null"), "owner_user_id").withColumn("kind", F.lit("clean list"))
    return clean.unionByName(jn.not_in(u, "id", closed, "owner_user_id").withColumn("kind", F.lit("list with null")))


@report("C23_null_safe", f"""
WITH x AS (SELECT owner_user_id, post_type_id, count(*) AS n FROM {b.POSTS} GROUP BY 1, 2)
SELECT q.owner_user_id, q.n AS questions, a.n AS answers FROM (SELECT * FROM x WHERE post_type_id = 1) q JOIN (SELECT * FROM x WHERE post_type_id = 2) a ON q.owner_user_id IS NOT DISTINCT FROM a.owner_user_id""")
def _(db):
    x = b.posts(db).groupBy("owner_user_id", "post_type_id").agg(F.count("*").alias("n"))
    q = x.filter("post_type_id = 1").select("owner_user_id", F.col("n").alias("questions"))
    a = x.filter("post_type_id = 2").select("owner_user_id", F.col("n").alias("answers"))
    return null_safe_join(q, a, ["owner_user_id"])


@report("C24_join_normalised", """
SELECT p.p_partkey, q.p_type AS kind FROM part p JOIN (SELECT DISTINCT upper(p_type) || ' Base' AS base, p_type FROM part) q ON lower(rtrim(p.p_type)) = replace(lower(q.base), ' base', '')""")
def _(db):
    a = db.part.select("p_partkey", F.concat("p_type", F.lit(" ratio  ")).alias("a_name"))
    base = db.part.select(F.concat(F.upper("p_type"), F.lit(" Base")).alias("b_name"), F.col("p_type").alias("kind")).distinct()
    return jn.join_normalised(a, base, [], "a_name", "b_name").select("p_partkey", "kind")


@report("C25_contains_join", "SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def _(db):
    return jn.contains_join(db.documents, "doc_id", "text", db.benchmark, "item_id", "text", max_terms=10)


@report("C26_longest_prefix", f"""
SELECT file_id, arg_max(volume, length(volume)) AS volume, arg_max(capacity_mb, length(volume)) AS capacity_mb FROM {b.FILES} f LEFT JOIN {b.VOLUMES} v ON starts_with(f.path, v.volume) GROUP BY 1""")
def _(db):
    return jn.longest_prefix_join(b.files(db), "file_id", "path", b.volumes(db), "volume", ["capacity_mb"], "/").select("file_id", "volume", "capacity_mb")


@report("C27_substring_key", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'Job = ' || c_name ELSE 'app ' || event_type END AS program FROM events LEFT JOIN customer ON event_type = 'error' AND c_custkey = user_id""")
def _(db):
    prog = E("CASE WHEN event_type = 'error' THEN concat('Agent - JobStep 0x', lpad(lower(hex(user_id)), 32, '0'), ' : 1') ELSE concat('app ', event_type) END")
    jobs = db.customer.select("c_custkey", F.col("c_name").alias("job_name"))
    return ss.resolve_job_name(db.events.withColumn("program", prog), "program", jobs, "c_custkey", "job_name").select("event_id", "program")


@report("C28_star_join", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, p_brand, s_name, o_orderpriority, c_mktsegment, n_name, r_name FROM lineitem
 LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN orders ON o_orderkey = l_orderkey
 LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""")
def _(db):
    dims = {
        "l_partkey": db.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"),
        "l_suppkey": db.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name"),
        "l_orderkey": db.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority", "o_custkey"),
        "o_custkey": db.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", F.col("c_nationkey").alias("n_nationkey")),
        "n_nationkey": db.nation,
        "n_regionkey": db.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name"),
    }
    return jn.denormalise(db.lineitem, dims).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "p_brand", "s_name", "o_orderpriority", "c_mktsegment", "n_name", "r_name")


@report("C29_polymorphic", """
SELECT event_id, event_type, c_name AS object_name FROM events JOIN customer ON c_custkey = user_id WHERE event_type = 'click'
UNION ALL SELECT event_id, event_type, s_name FROM events JOIN supplier ON s_suppkey = user_id WHERE event_type = 'view'
UNION ALL SELECT event_id, event_type, p_name FROM events JOIN part ON p_partkey = user_id WHERE event_type = 'error'""")
def _(db):
    dims = {"click": (db.customer, "c_custkey", "c_name"), "view": (db.supplier, "s_suppkey", "s_name"), "error": (db.part, "p_partkey", "p_name")}
    return jn.resolve_polymorphic(db.events, "event_type", "user_id", dims).select("event_id", "event_type", "object_name")


@report("C30_update_from", """
SELECT c_custkey, c_nationkey + coalesce(n, 0) AS score FROM customer LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) ON user_id = c_custkey""")
def _(db):
    n = db.events.groupBy("user_id").agg(F.count("*").alias("n"))
    return db.customer.join(n, E("user_id = c_custkey"), "left").select("c_custkey", (F.col("c_nationkey") + F.coalesce("n", F.lit(0))).alias("score"))


@report("C31_merge_hint", "SELECT o_orderkey, c_mktsegment FROM orders JOIN customer ON c_custkey = o_custkey")
def _(db):
    return db.orders.join(db.customer.hint("merge"), E("c_custkey = o_custkey")).select("o_orderkey", "c_mktsegment")


@report("C32_consecutive_pair", f"""
WITH s AS (SELECT DISTINCT snapshot, session_id, blocking_session_id FROM {b.SESSIONS} WHERE blocking_session_id IS NOT NULL)
SELECT a.snapshot, a.session_id, a.blocking_session_id FROM s a JOIN s p ON p.snapshot = a.snapshot - 1 AND p.session_id = a.session_id AND p.blocking_session_id = a.blocking_session_id""")
def _(db):
    s = b.sessions(db).filter("blocking_session_id is not null").select("snapshot", "session_id", "blocking_session_id").distinct()
    prev = s.select((F.col("snapshot") + 1).alias("snapshot"), "session_id", "blocking_session_id")
    return s.join(prev, ["snapshot", "session_id", "blocking_session_id"], "left_semi")


@report("C33_recursive", f"""
WITH RECURSIVE e AS (SELECT snapshot, session_id, blocking_session_id FROM {b.SESSIONS}), t AS (
 SELECT snapshot, session_id, 0 AS depth FROM e WHERE blocking_session_id IS NULL
 UNION ALL SELECT e.snapshot, e.session_id, t.depth + 1 FROM e JOIN t ON e.snapshot = t.snapshot AND e.blocking_session_id = t.session_id)
SELECT snapshot, session_id, depth::BIGINT AS depth FROM t WHERE depth > 0""")
def _(db):
    from opskit.operators.reshape import hierarchy
    return hierarchy(b.sessions(db), ["snapshot"], "session_id", "blocking_session_id").filter("depth > 0").select("snapshot", F.col("node").alias("session_id"), "depth")
