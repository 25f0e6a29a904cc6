"""Reconciliation and data quality (Q)."""

from pyspark.sql import functions as F

from opskit.operators import filters as fl
from opskit.operators import quality as ql
from opskit.plans import bindings as b
from opskit.plans.reports_reshape import SIGNATURE
from opskit.plans.registry import report

E = F.expr


@report("Q01_reconcile_counts", """
WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT user_id AS k, count(*) AS n FROM events GROUP BY 1)
SELECT k, coalesce(a.n, 0) AS n_a, coalesce(b.n, 0) AS n_b, coalesce(b.n, 0) - coalesce(a.n, 0) AS n_diff FROM a FULL JOIN b USING (k)""")
def _(db):
    a = db.orders.select(F.col("o_custkey").alias("k"))
    return ql.reconcile_counts(a, db.events.select(F.col("user_id").alias("k")), "k")


@report("Q02_orphans", """
SELECT doc_id, 'disk only' AS side FROM documents WHERE lang <> 'en' AND doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL
SELECT doc_id, 'registered only' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang <> 'en')""")
def _(db):
    return ql.orphans(db.documents.filter("lang <> 'en'"), db.labels, "doc_id")


@report("Q03_missing_names", "SELECT DISTINCT p_name || ' ' || p_brand AS name FROM part WHERE p_type = 'PROMO' AND name NOT IN (SELECT p_name || ' ' || p_brand FROM part WHERE p_size > 40)")
def _(db):
    part = db.part.withColumn("name", F.concat_ws(" ", "p_name", "p_brand"))
    return ql.missing_names(part.filter("p_type = 'PROMO'"), part.filter("p_size > 40"), "name")


@report("Q04_changed_since", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'")
def _(db):
    return fl.changed_since(db.orders, ["o_custkey", "o_orderstatus"], "o_orderdate", b.lit_ts("2001-01-01"))


@report("Q05_orphan_refs", f"SELECT count(*) AS orphans FROM {b.POST_LINKS} WHERE related_post_id NOT IN (SELECT id FROM {b.POSTS} WHERE closed_date IS NULL)")
def _(db):
    return ql.orphan_refs(b.post_links(db), "related_post_id", b.posts(db).filter("closed_date is null"), "id")


@report("Q06_completeness", f"""
SELECT server_id, 'env is missing' AS issue FROM {b.INV_SOURCE} WHERE env IS NULL UNION ALL SELECT server_id, 'no child rows' FROM {b.INV_SOURCE} WHERE server_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT server_id, 'no mapping' FROM {b.INV_SOURCE} WHERE server_id NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT DISTINCT c_custkey, 'listed but absent' FROM customer WHERE c_custkey % 2 = 0 AND c_custkey NOT IN (SELECT server_id FROM {b.INV_SOURCE})""")
def _(db):
    return ql.completeness(b.inventory_source(db), "server_id", ["name", "env", "ram"], db.orders.filter("o_orderstatus = 'F'"), "o_custkey",
                           db.supplier.select(F.col("s_suppkey").alias("server_id")), db.customer.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("server_id")))


@report("Q07_oversize_columns", """
SELECT 'p_name' AS column_name, max(length(p_name)) AS max_length, 55 AS declared, 55 - max(length(p_name)) AS unused FROM part UNION ALL
SELECT 'p_brand', max(length(p_brand)), 10, 10 - max(length(p_brand)) FROM part UNION ALL SELECT 'p_type', max(length(p_type)), 25, 25 - max(length(p_type)) FROM part""")
def _(db):
    return ql.oversize_columns(db.part, {"p_name": 55, "p_brand": 10, "p_type": 25})


@report("Q08_type_mismatches", """
WITH c AS (SELECT p_name AS column_name, p_type AS data_type, count(*) AS tables FROM part GROUP BY 1, 2)
SELECT *, tables * 100.0::DOUBLE / (sum(tables) OVER (PARTITION BY column_name))::BIGINT AS prevalence, count(*) OVER (PARTITION BY column_name) AS definitions FROM c QUALIFY count(*) OVER (PARTITION BY column_name) > 1""")
def _(db):
    return ql.type_mismatches(db.part.select(F.col("p_name").alias("column_name"), F.col("p_type").alias("data_type")))


@report("Q09_duplicate_definitions", f"""
WITH d AS (SELECT l_suppkey AS obj, l_partkey AS ix, max(l_returnflag) AS i, row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_linenumber) AS n FROM lineitem GROUP BY 1, 2, l_linenumber), s AS (SELECT obj, ix, {SIGNATURE} FROM d GROUP BY 1, 2),
 g AS (SELECT *, min(ix) OVER (PARTITION BY obj, signature) AS same_as, count(*) OVER (PARTITION BY obj, signature) AS copies FROM s)
SELECT * FROM g WHERE ix <> same_as""")
def _(db):
    items = db.lineitem.groupBy(F.col("l_suppkey").alias("obj"), F.col("l_partkey").alias("ix"), F.col("l_linenumber").alias("pos")).agg(F.max("l_returnflag").alias("item"))
    return ql.duplicate_definitions(items, "obj", "ix", "item", "pos")


@report("Q10_count_by_kind", "SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS \"F\", count(*) FILTER (o_orderstatus = 'O') AS \"O\", count(*) FILTER (o_orderstatus = 'P') AS \"P\" FROM orders GROUP BY 1")
def _(db):
    return ql.count_by_kind(db.orders, "o_custkey", "o_orderstatus", ["F", "O", "P"])


@report("Q11_lacking", "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 25)")
def _(db):
    return ql.lacking(db.part, "p_partkey", db.lineitem.filter("l_returnflag = 'R' and l_quantity > 25"), "l_partkey")


@report("Q12_table_sizes", """
SELECT c_custkey, n AS row_count, p AS pages, CASE WHEN p = 0 THEN '0' WHEN p * 8192 >= 1073741824 THEN (p * 8192 // 1073741824) || ' gb' WHEN p * 8192 >= 1048576 THEN (p * 8192 // 1048576) || ' mb' ELSE (p * 8192 // 1024) || ' kb' END AS size
FROM (SELECT c_custkey, coalesce(n, 0) AS n, coalesce(p, 0) AS p FROM customer LEFT JOIN (SELECT user_id, count(*) AS n, sum((props->>'$.k')::INT)::BIGINT AS p FROM events GROUP BY 1) ON user_id = c_custkey)""")
def _(db):
    parts = db.events.select(F.col("user_id").alias("c_custkey"), F.lit(1).alias("one"), E("cast(get_json_object(props, '$.k') as bigint)").alias("k"))
    return ql.table_sizes(db.customer.select("c_custkey"), parts, "c_custkey", "one", "k")


@report("Q13_permissions", """
WITH g AS (SELECT event_id, event_type AS class, user_id AS object_id, 'u' || (event_id % 9) AS grantee FROM events), x AS (
 SELECT g.*, c_name AS object_name FROM g JOIN customer ON c_custkey = object_id WHERE class = 'click' UNION ALL SELECT g.*, s_name FROM g JOIN supplier ON s_suppkey = object_id WHERE class = 'view' UNION ALL SELECT g.*, p_name FROM g JOIN part ON p_partkey = object_id WHERE class = 'error')
SELECT event_id, 'GRANT SELECT ON [' || object_name || '] TO [' || grantee || ']' AS grant_text FROM x""")
def _(db):
    g = db.events.select("event_id", F.col("event_type").alias("class"), F.col("user_id").alias("object_id"), E("concat('u', event_id % 9)").alias("grantee"),
                         F.lit("GRANT").alias("state"), F.lit("SELECT").alias("permission"))
    dims = {"click": (db.customer, "c_custkey", "c_name"), "view": (db.supplier, "s_suppkey", "s_name"), "error": (db.part, "p_partkey", "p_name")}
    return ql.permissions(g, dims).select("event_id", "grant_text")
