"""Pivots, exploding, nesting, markup and hierarchies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from opskit.functions import text
from opskit.operators.ordered import null_safe_join, running_sum_in
from opskit.session import durable

#: Columns that one pivot makes.
PIVOT_BLOCK = 1_000


def pivot_metrics(df: DataFrame, index: Sequence[str], key: str, names: Sequence[str], agg: Column) -> DataFrame:
    return df.groupBy(*index).pivot(key, list(names)).agg(agg)


def pivot_dynamic(df: DataFrame, index: Sequence[str], label: str, agg: Column, block: int = PIVOT_BLOCK) -> DataFrame:
    """Columns discovered from the data, in label order; the labels are the schema of the result.

    Up to ``block`` columns are made by one pivot. More are made in blocks of that many, each
    written once and joined to the index, so that no aggregation buffer grows with the labels.
    """
    names = [r[0] for r in df.select(label).distinct().orderBy(label).collect()]
    if len(names) <= block:
        return pivot_metrics(df, index, label, names, agg)
    rows = durable(df)
    out = durable(rows.select(*index).distinct())
    for i in range(0, len(names), block):
        some = names[i : i + block]
        inside = F.col(label).isin([n for n in some if n is not None])
        part = rows.filter(F.coalesce(inside, F.lit(None in some)) if None in some else inside)
        out = null_safe_join(out, durable(pivot_metrics(part, index, label, some, agg)), list(index), "left")
    return out


def bucket_counts(df: DataFrame, key: str, bucket: str, buckets: Sequence[str]) -> DataFrame:
    """Row count per key and bucket as columns (0 when none)."""
    return df.groupBy(key).agg(*[F.count(F.when(F.col(bucket) == b, 1)).alias(b) for b in buckets])


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "name", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def build_bridge(df: DataFrame, id_col: str, tags: str, dim: DataFrame, dim_id: str, dim_name: str) -> DataFrame:
    """Delimited tags to (id, tag id) rows."""
    names = df.select(id_col, F.explode(F.array_distinct(text.tag_list(tags))).alias("_name"))
    lookup = dim.select(F.col(dim_id), text.norm(dim_name).alias("_key"))
    return names.withColumn("_key", text.norm("_name")).join(lookup, "_key").select(id_col, dim_id)


def split_list(df: DataFrame, col: str, sep: str, keep: Sequence[str]) -> DataFrame:
    """One row per item with its 1-based position."""
    return df.select(*keep, F.posexplode(F.split(F.col(col), F.concat(F.lit("\\Q"), F.lit(sep), F.lit("\\E")))).alias("pos", "item")).withColumn(
        "pos", F.col("pos") + 1
    )


def select_names(names: DataFrame, col: str, kind: str, expr: str) -> DataFrame:
    """Comma list of names, ``%`` patterns and keywords; a leading ``-`` excludes.

    Keywords: ALL, SYSTEM and USER (by ``kind`` = 'S' or 'U').  A name is kept when some
    rule includes it and no rule excludes it.
    """
    include, exclude = F.lit(False), F.lit(False)
    for raw in (p.strip() for p in expr.split(",")):
        if not raw:
            continue
        item = raw[1:] if raw.startswith("-") else raw
        if item.startswith("[") and item.endswith("]"):
            item = item[1:-1]
        rule = {"ALL": F.lit(True), "SYSTEM": F.col(kind) == "S", "USER": F.col(kind) == "U"}.get(
            item, F.col(col).like(item.replace("_", "\\_"))
        )
        if raw.startswith("-"):
            exclude = exclude | rule
        else:
            include = include | rule
    return names.filter(include & ~exclude)


def explode_bits(df: DataFrame, mask: str, labels: Sequence[str]) -> DataFrame:
    """One row per set bit, with its position and label."""
    bits = F.array(*[F.struct(F.lit(i).alias("bit"), F.lit(1 << i).alias("w"), F.lit(n).alias("label")) for i, n in enumerate(labels)])
    hit = F.filter(bits, lambda b: F.col(mask).cast("bigint").bitwiseAND(b["w"].cast("bigint")) != 0)
    return df.withColumn("_b", F.explode(hit)).withColumn("bit", F.col("_b.bit")).withColumn("label", F.col("_b.label")).drop("_b")


def xml_escape(c: Column) -> Column:
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))


def attribute_escape(c: Column) -> Column:
    """Text of a double-quoted attribute on one line."""
    for raw, name in (('"', "&quot;"), ("\n", "&#10;"), ("\r", "&#13;")):
        c = F.replace(xml_escape(c) if raw == '"' else c, F.lit(raw), F.lit(name))
    return c


def row_xml(cols: Sequence[str], tag: str = "row") -> Column:
    """One element per row; NULL columns are left out."""
    parts = [
        F.coalesce(F.concat(F.lit(f"<{c}>"), xml_escape(F.col(c).cast("string")), F.lit(f"</{c}>")), F.lit("")) for c in cols
    ]
    return F.concat(F.lit(f"<{tag}>"), *parts, F.lit(f"</{tag}>"))


def html_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One ``<tr>`` line per row; NULL becomes a blank cell."""
    cells = [
        F.concat(F.lit("<td>"), F.coalesce(xml_escape(F.col(c).cast("string")), F.lit("")), F.lit("</td>")) for c in cols
    ]
    return df.withColumn("html", F.concat(F.lit("<tr>"), *cells, F.lit("</tr>")))


def html_table(df: DataFrame, cols: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """A top-k report as one HTML table (header and rows); ``k`` is the report's length."""
    top = html_rows(df, cols).orderBy(*order).limit(k)
    w = F.struct(F.monotonically_increasing_id().alias("i"), F.col("html").alias("h"))
    lines = F.transform(F.sort_array(F.collect_list("_w")), lambda x: x["h"])
    head = "<tr>" + "".join(f"<th>{c}</th>" for c in cols) + "</tr>"
    return top.coalesce(1).withColumn("_w", w).agg(
        F.concat(F.lit("<table>" + head), F.array_join(lines, ""), F.lit("</table>")).alias("html")
    )


def document_lines(df: DataFrame, parent: Sequence[str], child: Sequence[str], tag: str, item_tag: str) -> DataFrame:
    """Nested documents as lines (keys of the parent, kind, sort, line): opening, items, closing.

    A document is one element per parent with its keys as attributes, and one element per child
    row inside it, by ``child``. It has this shape at any size, and no row holds more than a line.
    """
    named = lambda cols: [F.coalesce(F.concat(F.lit(f' {c}="'), attribute_escape(F.col(c).cast("string")), F.lit('"')), F.lit("")) for c in cols]
    none = F.lit(None).cast(df.select(F.struct(*child)).schema[0].dataType)
    heads = df.select(*parent).distinct()
    edge = lambda kind, text_: heads.select(*parent, F.lit(kind).alias("kind"), none.alias("sort"), text_.alias("line"))
    items = df.select(*parent, F.lit(1).alias("kind"), F.struct(*child).alias("sort"), F.concat(F.lit(f"  <{item_tag}"), *named(child), F.lit("/>")).alias("line"))
    return edge(0, F.concat(F.lit(f"<{tag}"), *named(parent), F.lit(">"))).unionByName(items).unionByName(edge(2, F.lit(f"</{tag}>")))


def shred(df: DataFrame, col: str, row: str | None, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """Parse an XML column once with a fixed schema; ``row`` names a repeated path to explode."""
    parsed = df.select(*keep, F.from_xml(F.col(col), schema, {"valueTag": "_text"}).alias("doc"))
    if row is None:
        return parsed
    return parsed.select(*keep, "doc", F.explode_outer(f"doc.{row}").alias("node"))


# -- hierarchies ------------------------------------------------------------------------


def _one_parent(edges: DataFrame, keys: Sequence[str], node: str, parent: str) -> DataFrame:
    """One row (keys, node, parent) per node: the smallest real parent, else its own or none."""
    e = edges.select(*keys, F.col(node).alias("node"), F.col(parent).alias("parent")).filter("node is not null")
    real = F.min(F.when(F.col("parent") != F.col("node"), F.col("parent")))
    return e.groupBy(*keys, "node").agg(F.coalesce(real, F.min("parent")).alias("parent"))


def _jump(pointers: DataFrame, targets: DataFrame, keys: Sequence[str], *cols: Column) -> DataFrame:
    """Pointers (keys, node, anc, ...) joined with what is known of the node they point to, as ``_t``."""
    known = [c for c in targets.columns if c not in (*keys, "node")]
    t = targets.select(*keys, F.col("node").alias("anc"), F.struct(*known).alias("_t"))
    return null_safe_join(pointers, t, [*keys, "anc"]).select(*keys, "node", *cols)


def hierarchy(edges: DataFrame, keys: Sequence[str], node: str, parent: str) -> DataFrame:
    """Depth and sortable path of every node below its head, for trees of any depth.

    ``keys`` scope a tree (a snapshot). Heads have no parent (or are their own) and have at
    least one child. Every node has one row; of several parents the smallest counts. Each node
    holds a pointer to an ancestor, the distance and the path from there; a round joins it with
    the pointer of that ancestor, which doubles the distance, until it stands at a head: the
    rounds are the logarithm of the depth. A round in which no pointer arrives leaves only nodes
    on or under a cycle (``cycle``); their depth, path and head are null, as are those of nodes
    whose chain ends at a parent without a row.
    """
    e = durable(_one_parent(edges, keys, node, parent))
    linked = e.filter("parent is not null and parent <> node")
    has_child = linked.select(*keys, F.col("parent").alias("node")).distinct()
    heads = null_safe_join(e.filter("parent is null or parent = node"), has_child, [*keys, "node"], "left_semi")
    step = lambda df, anc, dist: df.select(
        *keys, "node", F.col(anc).alias("anc"), F.lit(dist).alias("dist"), text.sort_id("node").alias("path"), F.lit(dist == 0).alias("there"))
    done, climbing = durable(step(heads, "node", 0)), durable(step(linked, "parent", 1))
    left = climbing.count()
    while left:
        moved = durable(_jump(
            climbing, done.unionByName(climbing), keys, F.col("_t.anc").alias("anc"), (F.col("dist") + F.col("_t.dist")).alias("dist"),
            F.concat("_t.path", "path").alias("path"), F.col("_t.there").alias("there")))
        done, climbing, before = done.unionByName(moved.filter("there")), moved.filter("not there"), left
        left = climbing.count()
        if left == before:
            break
    depth, path, head = F.col("dist").alias("depth"), "path", F.col("anc").alias("head")
    reached = null_safe_join(done.select(*keys, "node", depth, path, head), e, [*keys, "node"]).select(
        *keys, "node", "parent", "depth", "path", "head", F.lit(False).alias("cycle"))
    lost = null_safe_join(linked, done.select(*keys, "node"), [*keys, "node"], "left_anti")
    lost = null_safe_join(lost, climbing.select(*keys, "node", F.lit(True).alias("cycle")), [*keys, "node"], "left")
    types = {f.name: f.dataType for f in reached.schema}
    none = lambda c: F.lit(None).cast(types[c]).alias(c)
    return reached.unionByName(lost.select(
        *keys, "node", "parent", none("depth"), none("path"), none("head"), F.coalesce("cycle", F.lit(False)).alias("cycle")))


def tree_label(depth: str | Column, node: str | Column, body: Column) -> Column:
    """Indented label of a tree line."""
    depth = F.col(depth) if isinstance(depth, str) else depth
    node = F.col(node) if isinstance(node, str) else node
    mark = F.when(depth == 0, F.lit("HEAD -  ")).otherwise(F.lit("|------  "))
    return F.concat(F.lit("    "), F.repeat(F.lit("|         "), depth.cast("int")), mark, node.cast("string"), F.lit(" "), body)


def _compose(pointers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pointers of twice the distance; those that would leave the top are gone."""
    return durable(_jump(pointers, pointers, keys, F.col("_t.anc").alias("anc")).distinct())


def reach(pointers: DataFrame, keys: Sequence[str], seeds: DataFrame) -> DataFrame:
    """All nodes on the way from the seeds along pointers (keys, node, anc), seeds included.

    After k rounds the nodes up to 2^k - 1 steps away are found, and pointers span 2^k steps:
    rounds are the logarithm of the longest way, and a round that finds nothing new is the end,
    on cycles too.
    """
    found, pointers = durable(seeds.select(*keys, "node").distinct()), durable(pointers.select(*keys, "node", "anc").distinct())
    while True:
        ahead = null_safe_join(pointers, found, [*keys, "node"], "left_semi").select(*keys, F.col("anc").alias("node")).distinct()
        fresh = durable(null_safe_join(ahead, found, [*keys, "node"], "left_anti"))
        if fresh.isEmpty():
            return found
        found, pointers = found.unionByName(fresh), _compose(pointers, keys)


def ancestors(edges: DataFrame, keys: Sequence[str], node: str, parent: str, seeds: DataFrame) -> DataFrame:
    """All distinct nodes found by walking from the seeds towards their parents, at any height."""
    up = edges.select(*keys, F.col(node).alias("node"), F.col(parent).alias("anc")).filter("node is not null and anc is not null")
    return reach(up, keys, seeds)


def _sizes(links: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(nodes with ``size``, pointers left): nodes under each node of a forest, itself included.

    ``size`` counts the nodes less than 2^k levels below; those from there on are counted at the
    nodes 2^k levels below, whose pointers end here. Pointers that are left stand on or under a
    cycle, and the sizes of their targets mean nothing.
    """
    ends = links.select(*keys, "node").unionByName(links.select(*keys, F.col("anc").alias("node")))
    size, pointers = durable(ends.distinct().withColumn("size", F.lit(1).cast("bigint"))), links
    left = pointers.count()
    while left:
        under = null_safe_join(pointers, size, [*keys, "node"]).groupBy(*keys, F.col("anc").alias("node")).agg(F.sum("size").alias("more"))
        size = durable(null_safe_join(size, under, [*keys, "node"], "left").select(
            *keys, "node", (F.col("size") + F.coalesce("more", F.lit(0))).alias("size")))
        pointers, before = _compose(pointers, keys), left
        left = pointers.count()
        if left == before:
            break
    return size, pointers


def _on_cycles(links: DataFrame, pointers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, node, loop): the nodes on cycles with the smallest node of their cycle.

    ``pointers`` all stand on or under cycles; the tails under a cycle are gone from their targets
    once those no longer get fewer.
    """
    ends = lambda p: durable(p.select(*keys, F.col("anc").alias("node")).distinct())
    on, n = ends(pointers), -1
    while (found := on.count()) != n:
        n, pointers = found, _compose(pointers, keys)
        on = ends(pointers)
    ring = durable(null_safe_join(links, on, [*keys, "node"], "left_semi"))
    loop = on.withColumn("loop", F.col("node"))
    while True:
        moved = durable(_jump(ring, loop, keys, F.col("anc"), F.col("_t.loop").alias("ahead")))
        least = null_safe_join(loop, moved.select(*keys, "node", "ahead"), [*keys, "node"]).select(
            *keys, "node", F.least("loop", "ahead").alias("loop"), (F.col("ahead") < F.col("loop")).alias("less"))
        least = durable(least)
        loop = least.drop("less")
        if least.filter("less").isEmpty():
            return loop
        ring = _compose(ring, keys)


def below_counts(edges: DataFrame, keys: Sequence[str], node: str, parent: str) -> DataFrame:
    """Number of nodes under every node, at all levels (nodes without any are left out).

    One row per node and round, and as many rounds as the logarithm of the depth. Every node has
    one parent (the smallest of several). All nodes of a cycle have the same nodes under them,
    the others of the cycle included: cycles are cut, sized as trees and added up.
    """
    e = _one_parent(edges, keys, node, parent).filter("parent is not null and parent <> node")
    links = durable(e.select(*keys, "node", F.col("parent").alias("anc")))
    size, stuck = _sizes(links, keys)
    if not stuck.isEmpty():
        loops = _on_cycles(links, stuck, keys)
        size, _ = _sizes(durable(null_safe_join(links, loops, [*keys, "node"], "left_anti")), keys)
        ring = null_safe_join(loops, size, [*keys, "node"], "left").withColumn("size", F.coalesce("size", F.lit(1)))
        whole = ring.groupBy(*keys, "loop").agg(F.sum("size").alias("size"))
        ring = null_safe_join(loops, whole, [*keys, "loop"]).select(*keys, "node", "size")
        size = null_safe_join(size, loops, [*keys, "node"], "left_anti").unionByName(ring)
    return size.filter("size > 1").select(*keys, "node", (F.col("size") - 1).alias("below"))


def descend(edges: DataFrame, node: str, parent: str, roots: DataFrame, levels: int) -> DataFrame:
    """Nodes exactly ``levels`` steps below the roots (a chain of semi joins)."""
    cur = roots.select(F.col(node))
    for _ in range(levels):
        cur = edges.join(cur.select(F.col(node).alias("_p")).distinct(), F.col(parent) == F.col("_p"), "left_semi").select(node)
    return cur


def folder_rollup(files: DataFrame, path: str, size: str, sep: str) -> DataFrame:
    """Total size and file count of every folder above a file, with the parent folder."""
    parts = F.split(F.col(path), F.concat(F.lit("\\Q"), F.lit(sep), F.lit("\\E")))
    folders = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, F.lit(1), i), sep)
    )
    out = files.select(F.explode(folders).alias("folder"), F.col(size).alias("_s")).groupBy("folder").agg(
        F.sum("_s").alias("size_bytes"), F.count("*").alias("items")
    )
    up = F.when(F.instr("folder", sep) > 0, text.dirname("folder", sep))
    return out.withColumn("parent", up)


def listed_signature(df: DataFrame, keys: Sequence[str], item: str, order: str) -> DataFrame:
    """The whole ordered item list of each key as one text, commas between the items.

    A comma or backslash inside an item has a backslash in front and a null item is ``\\N``, so
    different lists have different texts. The list is the result, so a row is as long as it;
    ``signature`` tells lists apart without building them.
    """
    text = F.col(item).cast("string")
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(","), F.lit("\\,"))
    rows = df.select(*keys, F.struct(F.col(order).alias("o"), F.coalesce(escaped, F.lit("\\N")).alias("i")).alias("_item"))
    listed = F.transform(F.sort_array(F.collect_list("_item")), lambda x: x["i"])
    return rows.groupBy(*keys).agg(F.array_join(listed, ",").alias("signature"))


def signature(df: DataFrame, keys: Sequence[str], item: str, order: str) -> DataFrame:
    """Digest of the ordered item list of each key: equal lists have equal digests.

    Items are numbered in order inside their key (over balanced ranges), and the digest combines
    two 60-bit hashes of number and item by exclusive or, map-side, so no list is built (numbers
    differ, so nothing cancels out). The length of the list stands in front; a null item differs
    from an empty text.
    """
    rows = df.select(*keys, F.col(order).alias("_o"), F.col(item).cast("string").alias("_i"), F.lit(1).cast("bigint").alias("_one"))
    numbered = running_sum_in(rows, list(keys), "_one", ["_o", "_i"], "_n")
    digest = F.md5(F.concat(F.col("_n").cast("string"), F.coalesce(F.concat(F.lit(":"), "_i"), F.lit(""))).cast("binary"))
    half = lambda i: F.bit_xor(F.conv(F.substring(digest, i, 15), 16, 10).cast("bigint")).cast("string")
    return numbered.groupBy(*keys).agg(F.concat_ws("-", F.count("*").cast("string"), half(1), half(17)).alias("signature"))
