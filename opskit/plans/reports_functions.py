"""Scalar functions (L), each evaluated over a whole given table."""

from pyspark.sql import functions as F

from opskit.functions import clock, text, units
from opskit.plans.registry import report, stamp

NAMES = "(SELECT *, 'srv' || c_nationkey || '.corp' || (c_custkey % 3) || '.example' AS fqdn, c_mktsegment || '.dbo.' || c_name AS dotted FROM customer)"


def _names(db):
    return db.customer.select(
        "*",
        F.concat(F.lit("srv"), "c_nationkey", F.lit(".corp"), F.col("c_custkey") % 3, F.lit(".example")).alias("fqdn"),
        F.concat_ws(".", "c_mktsegment", F.lit("dbo"), "c_name").alias("dotted"),
    )


@report("L01_substring_position", """
SELECT p_partkey, instr(p_name, ' ') AS pos, left(p_name, 3) AS l3, right(p_name, 3) AS r3,
       substr(p_name, 2, 3) AS mid, length(rtrim(p_name)) AS len FROM part""")
def _(db):
    return db.part.select(
        "p_partkey", text.position(" ", "p_name").alias("pos"), F.left("p_name", F.lit(3)).alias("l3"),
        F.right("p_name", F.lit(3)).alias("r3"), F.substring("p_name", 2, 3).alias("mid"),
        text.trimmed_length("p_name").alias("len"))


@report("L02_last_segment", """
SELECT page_id, split_part(url, '/', -1) AS last_part,
       left(url, length(url) - length(split_part(url, '/', -1)) - 1) AS folder FROM pages""")
def _(db):
    return db.pages.select("page_id", text.last_segment("url", "/").alias("last_part"), text.dirname("url", "/").alias("folder"))


@report("L03_strip_markers", r"""
SELECT doc_id, length(replace(replace(text, chr(10), ''), chr(13), '')) AS len,
       md5(replace(replace(text, chr(10), ''), chr(13), '')) AS digest FROM documents""")
def _(db):
    clean = text.strip_markers("text", ("\r", "\n"))
    return db.documents.select("doc_id", F.length(clean).alias("len"), F.md5(clean).alias("digest"))


@report("L04_stuff", "SELECT p_partkey, left(p_name, 1) || 'XX' || substr(p_name, 4) AS stuffed FROM part")
def _(db):
    return db.part.select("p_partkey", text.stuff("p_name", 2, 2, "XX").alias("stuffed"))


@report("L05_pad", "SELECT c_custkey, lpad(c_custkey::varchar, 10, '0') AS padded, repeat('|  ', c_nationkey % 4) AS indent FROM customer")
def _(db):
    return db.customer.select(
        "c_custkey", text.pad_id("c_custkey").alias("padded"),
        F.repeat(F.lit("|  "), F.col("c_nationkey") % 4).alias("indent"))


@report("L06_norm", "SELECT lower(rtrim(c_mktsegment)) AS segment, upper(ltrim(min(c_name))) AS first_name, count(*) AS n FROM customer GROUP BY 1")
def _(db):
    return db.customer.groupBy(text.norm("c_mktsegment").alias("segment")).agg(
        F.upper(F.ltrim(F.min("c_name"))).alias("first_name"), F.count("*").alias("n"))


@report("L07_bracket", "SELECT p_partkey, '[' || replace(p_name, ']', ']]') || ']' AS quoted FROM part")
def _(db):
    return db.part.select("p_partkey", text.bracket("p_name").alias("quoted"))


@report("L08_name_part", f"SELECT c_custkey, split_part(dotted, '.', 3) AS object, split_part(dotted, '.', 2) AS owner, split_part(dotted, '.', 1) AS db FROM {NAMES}")
def _(db):
    return _names(db).select(
        "c_custkey", text.name_part("dotted", 1).alias("object"), text.name_part("dotted", 2).alias("owner"),
        text.name_part("dotted", 3).alias("db"))


@report("L09_pattern_position", r"""
SELECT page_id, CASE WHEN regexp_matches(url, '[0-9]') THEN length(regexp_extract(url, '^([^0-9]*)', 1)) + 1 ELSE 0 END AS pos FROM pages""")
def _(db):
    return db.pages.select("page_id", text.pattern_position("url", "[0-9]").alias("pos"))


@report("L10_concat_null_as_empty", """
SELECT d.doc_id, concat(d.source, '/', d.lang, '/', l.quality) AS label FROM documents d LEFT JOIN labels l USING (doc_id)""")
def _(db):
    return db.documents.join(db.labels, "doc_id", "left").select(
        "doc_id", text.concat_nn("source", F.lit("/"), "lang", F.lit("/"), "quality").alias("label"))


@report("L11_split", """
SELECT p_partkey, len([x for x in string_split(p_name, ' ') if trim(x) <> '']) AS words, trim(string_split(p_name, ' ')[1]) AS first_word FROM part""")
def _(db):
    items = text.split_clean("p_name", " ")
    return db.part.select("p_partkey", F.size(items).alias("words"), F.get(items, F.lit(0)).alias("first_word"))


@report("L12_format_date", """
SELECT strftime(o_orderdate, '%y-%m') AS ym, count(*) AS n, min(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')) AS first_day FROM orders GROUP BY 1""")
def _(db):
    return db.orders.groupBy(clock.fmt_date("o_orderdate", "yy-MM").alias("ym")).agg(
        F.count("*").alias("n"), F.min(clock.fmt_date("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("first_day"))


@report("L13_null_handling", """
SELECT d.doc_id, coalesce(l.quality, -1)::bigint AS quality, nullif(l.toxic, 0)::bigint AS toxic_or_null,
       CASE WHEN l.doc_id IS NULL THEN 'none' ELSE 'labelled' END AS state FROM documents d LEFT JOIN labels l USING (doc_id)""")
def _(db):
    l = db.labels.withColumn("hit", F.lit(True))
    return db.documents.join(l, "doc_id", "left").select(
        "doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), F.nullif("toxic", F.lit(0)).alias("toxic_or_null"),
        F.when(F.col("hit").isNull(), "none").otherwise("labelled").alias("state"))


@report("L14_boundary_difference", f"""
SELECT event_id, date_diff('minute', TIMESTAMP '2024-01-01 00:00:59', ts) AS minutes,
       date_diff('hour', TIMESTAMP '2024-01-01 00:00:59', ts) AS hours, date_diff('day', TIMESTAMP '2024-01-01 00:00:59', ts) AS days,
       {stamp("ts + INTERVAL 36 HOUR")} AS later, year(ts) AS y, month(ts) AS m FROM events""")
def _(db):
    start = F.lit("2024-01-01 00:00:59").cast("timestamp_ntz")
    return db.events.select(
        "event_id", *[clock.datediff_boundary(u, start, "ts").alias(f"{u}s") for u in ("minute", "hour", "day")],
        (F.col("ts") + F.expr("interval 36 hours")).alias("later"), F.year("ts").alias("y"), F.month("ts").alias("m"))


@report("L15_now_argument", """
SELECT c_custkey, date_diff('day', max(o_orderdate), TIMESTAMP '2001-09-01') AS age_days FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def _(db):
    now = F.lit("2001-09-01").cast("timestamp_ntz")
    last = db.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("last"))
    return db.customer.join(last, "c_custkey").select("c_custkey", clock.datediff_boundary("day", "last", now).alias("age_days"))


@report("L16_time_zone", f"""
SELECT event_id, {stamp("ts + INTERVAL 330 MINUTE")} AS local_time, {stamp("ts - INTERVAL 330 MINUTE")} AS utc_time FROM events""")
def _(db):
    return db.events.select("event_id", clock.to_local("ts", "+05:30").alias("local_time"), clock.to_utc("ts", "+05:30").alias("utc_time"))


@report("L17_math", """
SELECT event_id, floor(value)::bigint AS fl, ceil(value)::bigint AS ce, round(sqrt(value), 6) AS sq, abs(value - 10) > 5 AS far,
       event_id % 7 AS md, (event_id & 6) AS bits FROM events""")
def _(db):
    v = F.col("value")
    return db.events.select(
        "event_id", F.floor(v).alias("fl"), F.ceil(v).alias("ce"), F.round(F.sqrt(v), 6).alias("sq"),
        (F.abs(v - 10) > 5).alias("far"), (F.col("event_id") % 7).alias("md"), F.col("event_id").bitwiseAND(F.lit(6)).alias("bits"))


@report("L18_number_text", """
SELECT o_orderkey, replace(format('{:,}', floor(o_totalprice)::bigint), ',', '')::bigint AS amount FROM orders""")
def _(db):
    shown = F.format_number(F.floor("o_totalprice"), 0)
    return db.orders.select("o_orderkey", text.to_long(shown).alias("amount"))


@report("L19_pseudo_random", """
SELECT p_partkey, ('0x' || substr(md5(p_partkey::varchar || '/7'), 1, 8))::bigint / 4294967296.0 AS r FROM part""")
def _(db):
    return db.part.select("p_partkey", text.pseudo_random("p_partkey", 7).alias("r"))


@report("L20_xml_value", r"""
SELECT page_id, coalesce(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '') AS title, regexp_extract(html, 'lang="([^"]*)"', 1) AS lang FROM pages""")
def _(db):
    return db.pages.select(
        "page_id", F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract("html", r'lang="([^"]*)"', 1).alias("lang"))


@report("L21_row_markup", """
SELECT s_suppkey, '<row><s_suppkey>' || s_suppkey || '</s_suppkey><s_name>' || s_name || '</s_name></row>' AS xml FROM supplier""")
def _(db):
    from opskit.operators.reshape import row_xml
    return db.supplier.select("s_suppkey", row_xml(["s_suppkey", "s_name"]).alias("xml"))


@report("L22_statement_slice", """
SELECT p_partkey, substr(p_name, (p_size % 4) + 1, CASE WHEN p_size % 2 = 0 THEN length(p_name) - (p_size % 4) + 1 ELSE 4 END) AS piece FROM part""")
def _(db):
    start = (F.col("p_size") % 4) * 2
    end = F.when(F.col("p_size") % 2 == 0, -1).otherwise(start + 6)
    return db.part.select("p_partkey", text.statement_slice("p_name", start, end).alias("piece"))


@report("L23_hex", "SELECT s_suppkey, '0x' || hex(encode(s_name)) AS sid FROM supplier")
def _(db):
    return db.supplier.select("s_suppkey", text.hex0x(F.col("s_name").cast("binary")).alias("sid"))


def wait_texts(db):
    """Wait texts in both shapes, derived from the events table."""
    k = F.get_json_object("props", "$.k").cast("int")
    v = F.floor(F.col("value") * 100).cast("bigint")
    kind = F.concat(F.when(F.col("event_type") == "error", "LCK_M_").otherwise("IO_"), F.upper("event_type"))
    many = F.concat(F.lit("("), (k % 7 + 2), F.lit("x: "), v, F.lit("/"), v + k, F.lit("/"), v + 2 * k, F.lit("ms)"), kind)
    one = F.concat(F.lit("("), v, F.lit("ms)"), kind)
    return db.events.withColumn("k", k).withColumn("v", v).withColumn(
        "wait_info",
        F.when(k % 5 == 0, F.lit(None).cast("string")).when(k % 5 == 1, one)
        .when(k % 5 == 2, F.concat(many, F.lit(", (7ms)LCK_M_U"))).otherwise(many))


WAITS = """(SELECT *, (props->>'$.k')::int AS k, floor(value * 100)::bigint AS v FROM events)"""


@report("L30_parse_waits", f"""
SELECT event_id, (CASE WHEN k % 5 = 2 THEN 2 ELSE 1 END)::bigint AS waits,
       (CASE WHEN k % 5 = 1 THEN 1 ELSE k % 7 + 2 END)::bigint AS tasks,
       (CASE WHEN k % 5 = 1 THEN v WHEN k % 5 = 2 THEN greatest(v + 2 * k, 7) ELSE v + 2 * k END)::bigint AS max_ms,
       CASE WHEN event_type = 'error' THEN 'LCK_M_ERROR' WHEN k % 5 = 2 THEN 'LCK_M_U' END AS lock_type
FROM {WAITS} WHERE k % 5 <> 0""")
def _(db):
    w = wait_texts(db).filter("wait_info is not null").withColumn("w", text.parse_waits("wait_info"))
    return w.select(
        "event_id", F.size("w").alias("waits"), F.col("w")[0]["tasks"].alias("tasks"),
        text.max_wait_ms("wait_info").alias("max_ms"), text.lock_wait("wait_info")["type"].alias("lock_type"))


DUR = "(SELECT *, ((l_orderkey % 60) * 10000 + (l_partkey % 60) * 100 + l_suppkey % 60) AS hms FROM lineitem)"


def durations(db):
    return db.lineitem.withColumn(
        "hms", (F.col("l_orderkey") % 60) * 10000 + (F.col("l_partkey") % 60) * 100 + F.col("l_suppkey") % 60)


@report("L40_duration_minutes", f"""
SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, hms,
       (hms // 10000) * 60 + (hms // 100) % 100 + CASE WHEN hms % 100 > 29 THEN 1 ELSE 0 END AS half_up,
       ((hms // 10000) * 3600 + (hms // 100) % 100 * 60 + hms % 100 + 31) // 60 AS plus31 FROM {DUR}""")
def _(db):
    return durations(db).select(
        "l_orderkey", "l_linenumber", "hms", clock.hhmmss_to_minutes("hms").alias("half_up"),
        clock.hhmmss_to_minutes("hms", "plus31").alias("plus31"))


@report("L41_int_datetime", f"""
SELECT l_orderkey, l_linenumber::bigint AS l_linenumber,
       {stamp("date_trunc('day', l_shipdate) + to_seconds((hms // 10000 % 24) * 3600 + (hms // 100) % 100 * 60 + hms % 100)")} AS at FROM {DUR}""")
def _(db):
    d = F.date_format("l_shipdate", "yyyyMMdd").cast("int")
    return durations(db).select("l_orderkey", "l_linenumber", clock.int_datetime(d, F.col("hms") % 240000).alias("at"))


@report("L42_duration_text", f"""
SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, secs,
       printf('%02d %02d:%02d:%02d', secs // 86400, secs // 3600 % 24, secs // 60 % 60, secs % 60) AS shown
FROM (SELECT *, hms * 7 AS secs FROM {DUR})""")
def _(db):
    d = durations(db).withColumn("shown", clock.fmt_duration(F.col("hms") * 7))
    return d.select("l_orderkey", "l_linenumber", clock.parse_duration("shown").alias("secs"), "shown")


@report("L43_size_text", """
SELECT doc_id, CASE WHEN b = 0 THEN '0' WHEN b >= 1073741824 THEN (b // 1073741824) || ' gb' WHEN b >= 1048576 THEN (b // 1048576) || ' mb'
       ELSE (b // 1024) || ' kb' END AS shown, n_chars * 1024 AS bytes FROM (SELECT doc_id, n_chars, n_chars * 50000 AS b FROM documents)""")
def _(db):
    return db.documents.select(
        "doc_id", units.fmt_size(F.col("n_chars") * 50000).alias("shown"),
        units.parse_size(F.concat("n_chars", F.lit(" KB"))).alias("bytes"))


@report("L44_host_parts", f"""
SELECT c_custkey, 'srv' || c_nationkey AS host, 'corp' || (c_custkey % 3) || '.example' AS domain,
       CASE WHEN c_custkey % 2 = 0 THEN 'I' || c_nationkey END AS instance FROM customer""")
def _(db):
    full = F.when(F.col("c_custkey") % 2 == 0, F.concat("fqdn", F.lit("\\I"), "c_nationkey")).otherwise(F.col("fqdn"))
    return _names(db).withColumn("full", full).select(
        "c_custkey", text.host("full").alias("host"), text.domain("full").alias("domain"), text.instance("full").alias("instance"))
