"""Merkle manifest of a dataset as a persistent tree with path copying, in DataFrame functions.

Leaves are rows; 16 neighbours make a node. The tree is worked on in aligned blocks of 4096
nodes: a block makes three levels at once from its own nodes, its top is one node of the next
round, so rounds grow with the logarithm of the rows. A changed leaf makes a new version that
shares every untouched node: only its ancestors are copied, first inside its block, then along
the path that the block got from the blocks above. No version is built anew, and no task holds
more than one block.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from opskit.llm.common import durable
from opskit.operators.ordered import global_row_number, null_safe_join, running_sum_in

FAN, LEVELS = 16, 3
#: Nodes of an aligned block, the most that a task takes together.
BLOCK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*values: Column) -> Column:
    return F.sha2(F.concat(*values), 256)


def row_digest(*fields: Column) -> Column:
    """Digest of a row: every field as byte count, colon and value, a null as a dash."""
    shown = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in shown])


def lower_ascii(c: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(c, upper, upper.lower())


def every_fifth(doc_id: Column) -> Column:
    """Rows whose id, as text, has a crc32 that 5 divides; a null id is none of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` applied to a value that is computed once."""
    return F.get(F.transform(F.array(value), use), 0)


# -- the original tree --------------------------------------------------------------------


def _above(level: Column) -> Column:
    """The nodes over a level: digests of 16 neighbours each."""
    runs = F.sequence(F.lit(0), F.call_function("div", F.size(level) - 1, F.lit(FAN)))
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(level, (i * FAN + 1).cast("int"), FAN), "")))


def _blocks(nodes: DataFrame) -> DataFrame:
    """Aligned blocks of a round: rows (tree, block, nodes, levels, top, done).

    ``nodes`` has tree, pos (from 0), node, done and more. Later blocks and full ones make three
    levels; a first block that is not full is its whole tree and ends when one node remains. Such
    a tree is ``done`` and goes through the further rounds as a single node.
    """
    rest = [c for c in nodes.columns if c not in ("tree", "done", "pos")]
    block = F.call_function("div", F.col("pos"), F.lit(BLOCK)).alias("block")
    own = nodes.groupBy("tree", block).agg(F.first("done").alias("done"), F.sort_array(F.collect_list(F.struct("pos", *rest))).alias("nodes"))
    whole = (F.col("block") == 0) & (F.size("nodes") < BLOCK)
    height = reduce(lambda h, k: h + F.when(~whole | (F.size("nodes") > FAN**k), 1).otherwise(0), range(LEVELS), F.lit(0))
    first = F.array(F.transform("nodes", lambda x: x["node"]))
    grown = lambda levels, _: F.concat(levels, F.array(_above(F.element_at(levels, -1))))
    levels = F.aggregate(F.slice(F.array(*map(F.lit, range(LEVELS))), F.lit(1), height), first, grown)
    return own.withColumn("levels", levels).withColumn("top", F.get(F.element_at("levels", -1), 0))


def grow(nodes: DataFrame) -> list[DataFrame]:
    """All rounds of the trees over ``nodes`` (tree, pos, node and more), from the leaves up.

    The number of rounds is the logarithm of the largest tree to the base 4096; in the last one
    every tree has one block.
    """
    rounds, nodes = [], nodes.withColumn("done", F.lit(False))
    while True:
        blocks = durable(_blocks(nodes))
        rounds.append(blocks)
        if blocks.filter("block > 0").isEmpty():
            return rounds
        over = F.col("done") | (F.size("levels") <= LEVELS)
        nodes = blocks.select("tree", F.col("block").alias("pos"), F.col("top").alias("node"), over.alias("done"))


def roots(rounds: list[DataFrame]) -> DataFrame:
    """(tree, root): the one node that remains of every tree."""
    return rounds[-1].select("tree", F.col("top").alias("root"))


# -- paths and versions -------------------------------------------------------------------


def _siblings(levels: Column, place: Column) -> Column:
    """The path of a block's node: texts left and right of it at every level of the block."""

    def beside(level, k):
        i = F.call_function("div", place, F.element_at(F.array(*[F.lit(FAN**j) for j in range(LEVELS + 1)]), k + 1)).cast("int")
        k_in = i % FAN
        left = F.array_join(F.slice(level, i - k_in + 1, k_in), "")
        return F.struct(left.alias("left"), F.array_join(F.slice(level, i + 2, FAN - 1 - k_in), "").alias("right"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), beside)


def copied(path: Column, node: Column) -> Column:
    """The new version's nodes from a changed node up to the root; the last one is the root."""
    up = lambda made, s: F.concat(made, F.array(digest(s["left"], F.element_at(made, -1), s["right"])))
    return F.aggregate(path, F.array(node), up)


def with_paths(rounds: list[DataFrame], over: DataFrame) -> DataFrame:
    """The leaf blocks with ``path``, the siblings from the block's top to the final root.

    ``over`` has one row per tree: tree, path (above the tree's root) and more, which is kept.
    Each round hands its blocks' paths to the blocks of the round below.
    """
    more = [c for c in over.columns if c not in ("tree", "path")]
    whole = null_safe_join(rounds[-1], over, ["tree"])
    for blocks in reversed(rounds[:-1]):
        below = F.transform("nodes", lambda x: F.struct(x["pos"].alias("block"), F.concat(_siblings(F.col("levels"), x["pos"] % BLOCK), F.col("path")).alias("path")))
        whole = null_safe_join(blocks, durable(whole.select("tree", *more, F.inline(below))), ["tree", "block"])
    return whole


def _forest(docs: DataFrame, tampered: Callable[[Column], Column]) -> tuple[list[DataFrame], list[DataFrame]]:
    """Rounds of the sources' trees, and of the tree over sources, whose rows keep ``source``."""
    text, fields = F.col("text"), [F.col(c) for c in FIELDS]
    changed = F.when(tampered(F.col("doc_id")), row_digest(*fields[:-1], lower_ascii(text)))
    rows = docs.select("doc_id", F.col("source").alias("tree"), row_digest(*fields).alias("node"), changed.alias("changed"), F.lit(1).cast("bigint").alias("one"))
    rows = durable(rows)  # texts are read once, before the rows are sampled for their ranges
    numbered = running_sum_in(rows, ["tree"], "one", ["doc_id", "node"], "pos").withColumn("pos", F.col("pos") - 1).drop("one")
    trees = grow(numbered)
    places = global_row_number(roots(trees), ["tree"], "pos").select(
        F.lit(0).alias("tree"), (F.col("pos") - 1).alias("pos"), F.col("root").alias("node"), F.col("tree").alias("source"))
    return trees, grow(places)


def _located(docs: DataFrame, tampered: Callable[[Column], Column]) -> DataFrame:
    """Leaf blocks of all sources with path, subroot and root."""
    trees, top = _forest(docs, tampered)
    summit = roots(top).select("tree", F.array().cast("array<struct<left:string,right:string>>").alias("path"), "root")
    places = with_paths(top, summit)
    one = lambda x: F.struct(
        x["source"].alias("tree"), x["node"].alias("subroot"), F.concat(_siblings(F.col("levels"), x["pos"] % BLOCK), F.col("path")).alias("path"))
    sources = durable(places.select("root", F.inline(F.transform("nodes", one))))
    return with_paths(trees, sources)


def _per_leaf(use: Callable[[Column, Column], Column]) -> Column:
    """``use(leaf, path)`` for every leaf of a block."""
    whole = lambda x: F.concat(_siblings(F.col("levels"), x["pos"] % BLOCK), F.col("path"))
    return F.transform("nodes", lambda x: _let(whole(x), lambda path: use(x, path)))


def nodes(docs: DataFrame) -> DataFrame:
    """The manifest: rows (source, level, pos, node) of every source's tree, leaves at level 0."""
    trees, _ = _forest(docs, lambda _: F.lit(False))
    out = []
    for r, blocks in enumerate(trees):
        level = blocks.filter("not done").select("tree", "block", F.posexplode("levels").alias("k", "nodes"))
        if r + 1 < len(trees):  # a block's top is a node of the next round
            level = level.filter(F.col("k") < LEVELS)
        made = level.select("tree", "block", "k", F.posexplode("nodes").alias("i", "node"))
        width = F.element_at(F.array(*[F.lit(FAN ** (LEVELS - k)) for k in range(LEVELS + 1)]), F.col("k") + 1)
        out.append(made.select(F.col("tree").alias("source"), (F.col("k") + r * LEVELS).alias("level"), (F.col("block") * width + F.col("i")).alias("pos"), "node"))
    return reduce(DataFrame.unionByName, out)


def versions(docs: DataFrame, tampered: Callable[[Column], Column] = every_fifth) -> DataFrame:
    """Copied nodes of every tampered leaf's version: (source, leaf, doc_id, height, node).

    ``leaf`` is the place in the source, ``height`` 0 the new leaf and the largest one the new
    root over all sources. All other nodes of a version are those of ``nodes``.
    """
    made = lambda x, path: F.struct(x["pos"].alias("leaf"), x["doc_id"].alias("doc_id"), copied(path, x["changed"]).alias("made"))
    rows = _located(docs, tampered).select(F.col("tree").alias("source"), F.inline(F.filter(_per_leaf(made), lambda v: F.get(v["made"], 0).isNotNull())))
    return rows.select("source", "leaf", "doc_id", F.posexplode("made").alias("height", "node"))


def verify(docs: DataFrame, tampered: Callable[[Column], Column] = every_fifth) -> DataFrame:
    """One row per document: its leaf, subroot, root, proof and the root that its version has.

    Columns doc_id, leaf, subroot, root, proof_sha256 (all of the original), folded_root (of
    the tampered leaf, else of the original one) and verified. ``docs`` has doc_id, source, lang,
    n_chars, text; further columns are ignored and nulls count as such. Rows with a null id come
    first and are not tampered; rows with one id go by their digest, and equal rows are leaves of
    their own. A null source is a source. Without documents there are no rows.
    """

    def judged(x, path):
        proof = digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))
        folded = F.element_at(copied(path, F.coalesce(x["changed"], x["node"])), -1)
        return F.struct(x["doc_id"].alias("doc_id"), x["node"].alias("leaf"), proof.alias("proof_sha256"), folded.alias("folded_root"))

    rows = _located(docs, tampered).select("subroot", "root", F.inline(_per_leaf(judged)))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
