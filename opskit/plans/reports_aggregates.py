"""Aggregations, windows, top-k and set operations (D, E, F, G)."""

from pyspark.sql import functions as F

from opskit.functions import units
from opskit.operators import aggregates as ag
from opskit.operators import filters as fl
from opskit.operators import ordered as od
from opskit.plans import bindings as b
from opskit.plans.registry import report, stamp

E = F.expr
CENTS = "sum(cast(round(value * 100) as bigint))"


@report("D01_group_by", """
SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty, sum(l_quantity) / count(*) AS avg_qty, min(l_discount) AS lo, max(l_tax) AS hi,
 sum(cast(round(l_extendedprice * 100) AS BIGINT)) / 100.0 AS revenue FROM lineitem GROUP BY 1, 2""")
def _(db):
    return db.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("qty"), (F.sum("l_quantity") / F.count("*")).alias("avg_qty"),
        F.min("l_discount").alias("lo"), F.max("l_tax").alias("hi"),
        (E("sum(cast(round(l_extendedprice * 100) as bigint))").cast("double") / 100.0).alias("revenue"))


@report("D02_conditional_sum", """
SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS failed, count(*) FILTER (o_orderstatus = 'O') AS ok FROM orders GROUP BY 1""")
def _(db):
    s = F.col("o_orderstatus")
    return db.orders.groupBy("o_custkey").agg(ag.sum_if(s == "F").alias("failed"), F.count_if(s == "O").alias("ok"))


@report("D03_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 12")
def _(db):
    return db.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).filter("n > 12")


@report("D04_count_distinct", "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1")
def _(db):
    return db.lineitem.groupBy("l_returnflag").agg(F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("suppliers"))


@report("D05_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def _(db):
    return db.part.select("p_brand", "p_type").distinct()


@report("D06_grouping_sets", """
SELECT p_type, p_brand, count(*) AS n, grouping(p_brand)::BIGINT AS is_total FROM part GROUP BY GROUPING SETS ((p_type), (p_type, p_brand))""")
def _(db):
    return ag.grouping_sets(db.part, [["p_type"], ["p_type", "p_brand"]], ["p_type", "p_brand"], F.count("*").alias("n"), F.grouping("p_brand").alias("is_total"))


@report("D07_correlated_counts", f"""
SELECT id, (SELECT count(*) FROM {b.POSTS} p WHERE p.owner_user_id = u.id AND post_type_id = 1) AS questions,
 (SELECT count(*) FROM {b.POSTS} p WHERE p.owner_user_id = u.id AND post_type_id = 2) AS answers FROM {b.USERS} u""")
def _(db):
    t = F.col("post_type_id")
    return ag.counts_per_key(b.users(db).select("id"), "id", b.posts(db).drop("id"), "owner_user_id", {"questions": t == 1, "answers": t == 2})


@report("D08_collapse_max", "SELECT o_custkey, max(o_orderkey) AS o_orderkey, max(o_orderstatus) AS o_orderstatus, max(o_totalprice) AS o_totalprice FROM orders GROUP BY 1")
def _(db):
    return ag.collapse_max(db.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice"), ["o_custkey"])


@report("D09_weighted_average", """
SELECT l_suppkey, round(sum(l_quantity * l_linenumber) / sum(l_linenumber) + 1e-9, 2) AS avg_qty FROM lineitem GROUP BY 1""")
def _(db):
    d = db.lineitem.withColumn("q", E("cast(l_quantity * l_linenumber as bigint)"))
    return d.groupBy("l_suppkey").agg(ag.weighted_avg("q", "l_linenumber").alias("avg_qty"))


@report("D10_global_aggregate", "SELECT count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi, count(DISTINCT o_custkey) AS customers FROM orders")
def _(db):
    return db.orders.agg(F.count("*").alias("n"), F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"), F.countDistinct("o_custkey").alias("customers"))


BYUSER = f"(SELECT user_id, {CENTS}::BIGINT AS v FROM events GROUP BY 1)"


def _by_user(db):
    return db.events.groupBy("user_id").agg(E(CENTS).alias("v"))


@report("D11_share_of_total", f"SELECT user_id, v, v * 100.0::DOUBLE / sum(v) OVER ()::DOUBLE AS percentage FROM {BYUSER}")
def _(db):
    return ag.share(_by_user(db), "v")


@report("D12_string_agg", "SELECT p_type, string_agg(DISTINCT p_brand, ', ' ORDER BY p_brand) AS brands FROM part GROUP BY 1")
def _(db):
    return db.part.groupBy("p_type").agg(ag.string_agg("p_brand", ", ", distinct=True).alias("brands"))


@report("D13_concatenate", "SELECT n_regionkey::BIGINT AS n_regionkey, string_agg(n_name, ',' ORDER BY n_nationkey) AS names FROM nation GROUP BY 1")
def _(db):
    return db.nation.groupBy("n_regionkey").agg(ag.string_agg("n_name", ",", F.col("n_nationkey")).alias("names"))


@report("D14_row_winner", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, least(l_quantity, l_discount * 100, l_tax * 400) AS best,
 CASE least(l_quantity, l_discount * 100, l_tax * 400) WHEN l_quantity THEN 'qty' WHEN l_discount * 100 THEN 'disc' ELSE 'tax' END AS winner FROM lineitem""")
def _(db):
    d = db.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").alias("qty"), E("l_discount * 100").alias("disc"), E("l_tax * 400").alias("tax"))
    return ag.row_winner(d, ["qty", "disc", "tax"]).drop("qty", "disc", "tax")


@report("D15_unit_rollup", "SELECT source, sum(n_chars)::BIGINT AS kb, (sum(n_chars) // 1024)::BIGINT AS mb FROM documents GROUP BY 1")
def _(db):
    return db.documents.groupBy("source").agg(F.sum("n_chars").alias("kb")).select("source", "kb", units.scale_units("kb", "KB", "MB").alias("mb"))


@report("D16_argmax", "SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1")
def _(db):
    return ag.argmax(db.orders.select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], ["o_orderkey"])


# -- windows ----------------------------------------------------------------------------


@report("E01_global_row_number", "SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS ranking FROM customer")
def _(db):
    d = db.customer.select("c_custkey", "c_acctbal")
    return od.global_row_number(d, [F.col("c_acctbal").desc(), F.col("c_custkey").asc()], "ranking").select("c_custkey", "ranking")


@report("E02_first_per_key", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def _(db):
    return od.first_per_key(db.orders, ["o_custkey"], ["o_totalprice", "o_orderkey"]).select("o_custkey", "o_orderkey")


@report("E03_latest_per_key", f"SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def _(db):
    return od.latest_per_key(db.events, ["user_id", "event_type"], "ts", ["event_id"]).select("user_id", "event_type", "event_id")


@report("E04_one_per_bucket", f"""
SELECT event_id, {stamp("bucket")} AS bucket FROM (SELECT event_id, date_trunc('hour', ts)::TIMESTAMP AS bucket, row_number() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def _(db):
    return fl.one_per_bucket(db.events, "ts", F.date_trunc("hour", "ts"), tie=["event_id"]).select("event_id", "bucket")


@report("E05_snapshot_number", "SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderdate) AS batch FROM orders")
def _(db):
    return od.global_dense_rank(db.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate"], "batch").select("o_orderkey", "batch")


@report("E06_surrogate_id", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, dense_rank() OVER (ORDER BY l_suppkey, l_returnflag, l_linestatus) AS batch_id FROM lineitem")
def _(db):
    keys = ["l_suppkey", "l_returnflag", "l_linestatus"]
    return od.global_dense_rank(db.lineitem, keys, "batch_id").select("l_orderkey", "l_linenumber", "l_partkey", "batch_id")


@report("E07_rank_groups", "SELECT o_orderdate::VARCHAR AS day, n, rank() OVER (ORDER BY n DESC) AS rank FROM (SELECT o_orderdate::DATE AS o_orderdate, count(*) AS n FROM orders GROUP BY 1)")
def _(db):
    per_day = db.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))
    return ag.rank_groups(per_day, ["n"], desc=True)


@report("E08_ntile", "SELECT p_partkey, ntile(7) OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS tile FROM part")
def _(db):
    d = db.part.select("p_partkey", "p_type", "p_retailprice")
    return od.ntile_in(d, 7, ["p_type"], [F.col("p_retailprice").desc(), F.col("p_partkey").asc()]).select("p_partkey", "tile")


@report("E09_lag", "SELECT event_id, lag(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS prev_value FROM events")
def _(db):
    return od.series_lag(db.events, ["user_id", "event_type"], ["ts", "event_id"], ["value"]).select("event_id", "prev_value")


@report("E10_share_in_group", """
SELECT p_brand, p_type, n, n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY p_type)::DOUBLE AS percentage FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2)""")
def _(db):
    return ag.share(db.part.groupBy("p_brand", "p_type").agg(F.count("*").alias("n")), "n", by=["p_type"])


@report("E11_group_size", "SELECT o_orderkey, count(*) OVER (PARTITION BY o_orderstatus, o_custkey) AS similar FROM orders")
def _(db):
    return od.with_group(db.orders, ["o_orderstatus", "o_custkey"], similar=F.count("*")).select("o_orderkey", "similar")


@report("E12_group_max", "SELECT o_orderkey, max(o_totalprice) OVER (PARTITION BY o_custkey) AS top_price FROM orders")
def _(db):
    return od.with_group(db.orders, ["o_custkey"], top_price=F.max("o_totalprice")).select("o_orderkey", "top_price")


@report("E13_rank_aggregates", "SELECT l_partkey, qty, row_number() OVER (ORDER BY qty DESC, l_partkey) AS size_rank FROM (SELECT l_partkey, sum(l_quantity) AS qty FROM lineitem GROUP BY 1)")
def _(db):
    qty = db.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("qty"))
    return od.global_row_number(qty, [F.col("qty").desc(), F.col("l_partkey").asc()], "size_rank")


@report("E14_prevalence", "SELECT c_nationkey::BIGINT AS c_nationkey, count(*) AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER ()::DOUBLE AS percentage FROM customer GROUP BY 1")
def _(db):
    return ag.prevalence(db.customer, "c_nationkey")


@report("E15_global_running_sum", "SELECT o_orderkey, sum(cast(round(o_totalprice * 100) AS BIGINT)) OVER (ORDER BY o_orderdate, o_orderkey)::BIGINT AS running FROM orders")
def _(db):
    d = db.orders.select("o_orderkey", "o_orderdate", E("cast(round(o_totalprice * 100) as bigint)").alias("v"))
    return od.global_running_sum(d, "v", ["o_orderdate", "o_orderkey"]).select("o_orderkey", "running")


# -- sort and limit ---------------------------------------------------------------------


@report("F01_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def _(db):
    return ag.top_k(db.orders, [F.col("o_totalprice").desc()], 100, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@report("F02_top_k_ties", "SELECT l_orderkey, l_partkey, l_quantity FROM (SELECT *, rank() OVER (ORDER BY l_quantity DESC) AS r FROM lineitem) WHERE r <= 15")
def _(db):
    return ag.top_k_ties(db.lineitem.select("l_orderkey", "l_partkey", "l_quantity"), ["l_quantity"], 15)


@report("F03_offset_fetch", "SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100")
def _(db):
    return ag.page(db.orders, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 100, 50).select("o_orderkey")


@report("F04_order_by_expression", "SELECT c_custkey FROM customer ORDER BY abs(c_acctbal) / (c_nationkey + 1) DESC, c_custkey LIMIT 25")
def _(db):
    return ag.top_k(db.customer, [E("abs(c_acctbal) / (c_nationkey + 1)").desc()], 25, ["c_custkey"]).select("c_custkey")


@report("F05_latest_value", f"SELECT user_id, {stamp('max(ts)')} AS ts, arg_max(value, ts) AS value FROM events GROUP BY 1")
def _(db):
    return ag.latest_value(db.events, "ts", "value", ["user_id"], ["event_id"])


@report("F06_parameter_top_k", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice, p_partkey LIMIT 17")
def _(db):
    k = 17
    return ag.top_k(db.part, [F.col("p_retailprice").asc()], k, ["p_partkey"]).select("p_partkey", "p_retailprice")


@report("F07_order_by_name", "SELECT p_partkey, p_size::BIGINT AS p_size FROM part ORDER BY p_size DESC, p_partkey LIMIT 20")
def _(db):
    return ag.order_by_name(db.part, "p_size", ["p_size", "p_retailprice"], 20, ["p_partkey"]).select("p_partkey", "p_size")


# -- set operations ---------------------------------------------------------------------


@report("G01_union_all", "SELECT c_nationkey::BIGINT AS nation, c_acctbal AS bal FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier")
def _(db):
    return ag.union_all(db.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("bal")),
                        db.supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("bal")))


@report("G02_union_distinct", "SELECT l_partkey AS k FROM lineitem WHERE l_quantity > 45 UNION SELECT l_partkey FROM lineitem WHERE l_discount > 0.08")
def _(db):
    part = lambda cond: db.lineitem.filter(cond).select(F.col("l_partkey").alias("k"))
    return ag.union_distinct(part("l_quantity > 45"), part("l_discount > 0.08"))


@report("G03_except", "SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 400000")
def _(db):
    return ag.except_distinct(db.orders.filter("o_orderstatus = 'F'").select("o_custkey"), db.orders.filter("o_totalprice > 400000").select("o_custkey"))


@report("G04_union_tiers", f"""
SELECT {stamp("ts")} AS ts, event_type, v FROM (
 SELECT ts, event_type, cast(round(value * 100) AS BIGINT) AS v FROM events WHERE ts >= TIMESTAMP '2024-01-20'
 UNION ALL SELECT date_trunc('hour', ts)::TIMESTAMP, event_type, max(cast(round(value * 100) AS BIGINT)) FROM events WHERE date_trunc('hour', ts) < TIMESTAMP '2024-01-20' GROUP BY 1, 2)""")
def _(db):
    raw = db.events.select("ts", "event_type", E("cast(round(value * 100) as bigint)").alias("v"))
    hourly = raw.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), "event_type").agg(F.max("v").alias("v"))
    cut = b.lit_ts("2024-01-20")
    return ag.union_tiers("ts", [(raw, cut, None), (hourly, None, cut)])
