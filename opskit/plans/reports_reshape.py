"""Pivots, nesting, shredding and hierarchies (H)."""

from pyspark.sql import functions as F

from opskit.functions import text
from opskit.operators import reshape as rs
from opskit.plans import bindings as b
from opskit.plans.registry import report

E = F.expr
CENTS = "cast(round(value * 100) AS BIGINT)"


@report("H01_static_pivot", """
SELECT user_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'view') AS view FROM events GROUP BY 1""")
def _(db):
    p = rs.pivot_metrics(db.events, ["user_id"], "event_type", ["click", "view"], F.count("event_id"))
    return p.select("user_id", F.coalesce("click", F.lit(0)).alias("click"), F.coalesce("view", F.lit(0)).alias("view"))


LABELS = [f"srv{s}/{t} (k)" for s in range(3) for t in ("click", "error", "purchase", "signup", "view")]


@report("H02_dynamic_pivot", "SELECT strftime(ts, '%Y-%m-%d') AS day, " + ", ".join(
    f"max({CENTS}) FILTER ('srv' || (user_id % 3) || '/' || event_type || ' (k)' = '{n}') AS \"{n}\"" for n in LABELS) + " FROM events GROUP BY 1")
def _(db):
    d = db.events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("day"), E(CENTS).alias("v"),
        F.concat(F.lit("srv"), F.col("user_id") % 3, F.lit("/"), "event_type", F.lit(" (k)")).alias("label"))
    return rs.pivot_dynamic(d, ["day"], "label", F.max("v"))


@report("H03_bucket_counts", """
SELECT o_custkey, count(*) FILTER (b = 'low') AS low, count(*) FILTER (b = 'mid') AS mid, count(*) FILTER (b = 'high') AS high
FROM (SELECT *, CASE WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 300000 THEN 'mid' ELSE 'high' END AS b FROM orders) GROUP BY 1""")
def _(db):
    d = db.orders.withColumn("b", E("CASE WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 300000 THEN 'mid' ELSE 'high' END"))
    return rs.bucket_counts(d, "o_custkey", "b", ["low", "mid", "high"])


@report("H04_lines_to_columns", """
SELECT p_partkey, max(p_name) AS name, max(p_brand) AS brand, max(p_size)::BIGINT AS size FROM part GROUP BY 1""")
def _(db):
    line = F.concat_ws("|", "p_name", "p_brand", "p_size")
    items = rs.split_list(db.part.withColumn("line", line), "line", "|", ["p_partkey"])
    wide = rs.pivot_metrics(items, ["p_partkey"], "pos", [1, 2, 3], F.max("item"))
    return wide.select("p_partkey", F.col("1").alias("name"), F.col("2").alias("brand"), F.col("3").cast("bigint").alias("size"))


@report("H05_unpivot", """
SELECT s_suppkey, 'nation' AS name, s_nationkey::DOUBLE AS value FROM supplier UNION ALL SELECT s_suppkey, 'balance', s_acctbal FROM supplier""")
def _(db):
    d = db.supplier.select("s_suppkey", F.col("s_nationkey").cast("double").alias("nation"), F.col("s_acctbal").alias("balance"))
    return rs.unpivot(d, ["s_suppkey"], ["nation", "balance"])


@report("H06_tag_bridge", f"""
SELECT p_partkey, t.id FROM part JOIN {b.TAGS} t ON t.tag_name = p_brand""")
def _(db):
    d = db.part.withColumn("tags", F.concat(F.lit("<"), F.upper("p_brand"), F.lit("><"), "p_type", F.lit(">< >")))
    return rs.build_bridge(d, "p_partkey", "tags", b.tags(db), "id", "tag_name")


@report("H07_shred_xml", """
SELECT conv_id, turn, role, length(text) AS chars FROM conversations""")
def _(db):
    turn = F.concat(F.lit('<turn n="'), "turn", F.lit('" role="'), "role", F.lit('"><chars>'), F.length("text"), F.lit("</chars></turn>"))
    d = db.conversations.groupBy("conv_id", (F.col("turn") / 4).cast("int").alias("part")).agg(
        F.concat(F.lit("<conv>"), F.array_join(F.collect_list(turn), ""), F.lit("</conv>")).alias("xml"))
    node = rs.shred(d, "xml", "turn", "turn array<struct<_n: bigint, _role: string, chars: bigint>>", ["conv_id"])
    return node.select("conv_id", F.col("node._n").alias("turn"), F.col("node._role").alias("role"), F.col("node.chars").alias("chars"))


@report("H08_split_list", """
SELECT page_id, pos, item FROM (SELECT page_id, unnest(string_split(url, '/')) AS item, generate_subscripts(string_split(url, '/'), 1) AS pos FROM pages)""")
def _(db):
    return rs.split_list(db.pages, "url", "/", ["page_id"])


@report("H09_select_names", """
SELECT c_custkey, c_name FROM customer WHERE (c_mktsegment = 'BUILDING' OR c_name LIKE 'Customer#0000001%') AND NOT c_name LIKE '%7'""")
def _(db):
    d = db.customer.withColumn("kind", E("CASE WHEN c_mktsegment = 'BUILDING' THEN 'S' ELSE 'U' END"))
    return rs.select_names(d, "c_name", "kind", "SYSTEM, Customer#0000001%, -%7").select("c_custkey", "c_name")


TREE = f"""RECURSIVE e AS (SELECT snapshot, session_id AS node, blocking_session_id AS parent FROM {b.SESSIONS}), t AS (
 SELECT snapshot, node, parent, 0 AS depth, lpad(node::VARCHAR, 10, '0') AS path, node AS head FROM e WHERE parent IS NULL AND EXISTS (SELECT 1 FROM e c WHERE c.snapshot = e.snapshot AND c.parent = e.node)
 UNION ALL SELECT e.snapshot, e.node, e.parent, t.depth + 1, t.path || lpad(e.node::VARCHAR, 10, '0'), t.head FROM e JOIN t ON e.snapshot = t.snapshot AND e.parent = t.node)"""


@report("H10_hierarchy", f"WITH {TREE} SELECT snapshot, node, parent, depth::BIGINT AS depth, path, head, false AS cycle FROM t")
def _(db):
    return rs.hierarchy(b.sessions(db), ["snapshot"], "session_id", "blocking_session_id")


@report("H11_ancestors", f"""
WITH RECURSIVE e AS (SELECT snapshot, session_id AS node, blocking_session_id AS parent FROM {b.SESSIONS}), t AS (
 SELECT snapshot, session_id AS node FROM {b.SESSIONS} WHERE status = 'sleeping' UNION SELECT e.snapshot, e.parent FROM t JOIN e ON e.snapshot = t.snapshot AND e.node = t.node WHERE e.parent IS NOT NULL)
SELECT snapshot, node FROM t""")
def _(db):
    s = b.sessions(db)
    seeds = s.filter("status = 'sleeping'").select("snapshot", F.col("session_id").alias("node"))
    return rs.ancestors(s, ["snapshot"], "session_id", "blocking_session_id", seeds)


@report("H12_descend", """
SELECT conv_id * 100 + turn AS node FROM conversations WHERE turn = 3""")
def _(db):
    e = db.conversations.select(E("conv_id * 100 + turn").alias("node"), E("CASE WHEN turn > 0 THEN conv_id * 100 + turn - 1 END").alias("parent"))
    return rs.descend(e, "node", "parent", e.filter("parent is null"), 3)


@report("H13_folder_rollup", f"""
WITH f AS (SELECT *, string_split(path, '/') AS p FROM {b.FILES}), x AS (SELECT array_to_string(p[1:i], '/') AS folder, size_mb FROM (SELECT p, size_mb, unnest(range(1, len(p))) AS i FROM f))
SELECT folder, sum(size_mb)::BIGINT AS size_bytes, count(*) AS items, CASE WHEN contains(folder, '/') THEN array_to_string(string_split(folder, '/')[1:-2], '/') END AS parent FROM x GROUP BY folder""")
def _(db):
    return rs.folder_rollup(b.files(db), "path", "size_mb", "/")


@report("H14_split_waits", f"""
SELECT event_id, 'LCK_M_U' AS type, 7 AS max_ms FROM (SELECT *, (props->>'$.k')::INT AS k FROM events) WHERE k % 5 = 2
UNION ALL SELECT event_id, CASE WHEN event_type = 'error' THEN 'LCK_M_' ELSE 'IO_' END || upper(event_type), (floor(value * 100) + CASE WHEN k % 5 = 1 THEN 0 ELSE 2 * k END)::BIGINT FROM (SELECT *, (props->>'$.k')::INT AS k FROM events) WHERE k % 5 <> 0""")
def _(db):
    from opskit.plans.reports_functions import wait_texts
    w = wait_texts(db).filter("wait_info is not null").select("event_id", F.inline(text.parse_waits("wait_info")))
    return w.select("event_id", "type", "max_ms")


@report("H15_explode_bits", """
SELECT o_orderkey, i AS bit, ['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'][i + 1] AS label FROM orders, range(7) r(i) WHERE ((o_custkey % 128) >> i) & 1 = 1""")
def _(db):
    d = db.orders.withColumn("mask", F.col("o_custkey") % 128)
    return rs.explode_bits(d, "mask", ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]).select("o_orderkey", "bit", "label")


SIGNATURE = "count(*) || '-' || bit_xor(('0x' || substr(md5(n || coalesce(':' || i, '')), 1, 15))::BIGINT) || '-' || bit_xor(('0x' || substr(md5(n || coalesce(':' || i, '')), 17, 15))::BIGINT) AS signature"


@report("H16_signature", r"""
SELECT l_suppkey, string_agg(coalesce(replace(replace(f, '\', '\\'), ',', '\,'), '\N'), ',' ORDER BY l_linenumber NULLS FIRST) AS signature FROM (SELECT l_suppkey, l_linenumber, max(l_returnflag) AS f FROM lineitem GROUP BY 1, 2) GROUP BY 1""")
def _(db):
    d = db.lineitem.groupBy("l_suppkey", "l_linenumber").agg(F.max("l_returnflag").alias("f"))
    return rs.listed_signature(d, ["l_suppkey"], "f", "l_linenumber")
