"""MinHash near-duplicate detection with tensored banding.

Two small collections of ``m`` short hashes are computed per document. A table key combines
one hash of each collection, so ``2 * m`` short hashes serve ``m * m`` tables. Candidates are
confirmed on full shingle sets, and links are joined into components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from opskit.llm.common import batches_of, durable, lowered, mix, mixed_sequence, prefix_hash, range_hash, ranges, text_bytes, word_ranges
from opskit.operators.joins import broadcast_if_small

SHINGLE = 5
PERCENT = 75
#: Short hashes in a collection, and minhashes in a short hash. A pair at 0.75 shares a table with
#: probability (1 - (1 - 0.75**4)**22)**2 = 0.9995, one at 0.8 with 0.99998.
M, R = 22, 4
#: One bit of each of 512 minhashes. A pair at 0.75 differs in 64 bits on average, with a standard
#: deviation of 7.5; pairs that differ in more than DIFFER bits (6 deviations) are not confirmed.
BITS, DIFFER = 512, 109
#: Texts of an Arrow batch, and bytes of text that are hashed at once in a task.
ROWS, BYTES = 1000, 1 << 18
SKETCH = [f"s{i}" for i in range(BITS // 64)]


def _shingles(data: np.ndarray, offsets: np.ndarray, size: int):
    """For each document of a chunk its sorted distinct shingle hashes."""
    data = lowered(data)
    start, end, before = word_ranges(data, offsets)
    h = range_hash(prefix_hash(data), start, end)
    runs = mixed_sequence(h, size)
    for a, b in zip(before[:-1].tolist(), before[1:].tolist()):
        if b - a >= size:
            yield np.unique(runs[a : b - size + 1])
        elif b > a:
            yield mixed_sequence(h[a:b], b - a) ^ np.uint64(b - a)
        else:
            yield h[:0]


def _signatures(m: int, r: int, size: int):
    hashes = max(2 * m * r, BITS)
    seeds = np.random.default_rng(20_011).integers(1, 2**32, (hashes, 2), dtype=np.uint64).astype(np.uint32)
    seeds[:, 0] |= 1

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in ranges(offsets, BYTES):
                sets = list(_shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size))
                n = np.array([len(s) for s in sets])
                full = np.flatnonzero(n)
                short = np.zeros((len(sets), 2 * m), np.uint64)
                ids = np.zeros((len(sets), 2), np.uint64)
                sketch = np.zeros((len(sets), len(SKETCH)), np.int64)
                if len(full):
                    cut = np.concatenate(([0], np.cumsum(n[full])[:-1])).astype(np.int64)
                    flat = np.concatenate([sets[i] for i in full])
                    low = (flat >> np.uint64(32)).astype(np.uint32) ^ flat.astype(np.uint32)
                    mins = np.empty((hashes, len(full)), np.uint32)
                    for k, (x, y) in enumerate(seeds):
                        mins[k] = np.minimum.reduceat(low * x + y, cut)
                    for k in range(2 * m):
                        short[full, k] = mixed_sequence(mins[k * r : k * r + r].T.astype(np.uint64).ravel(), r)[::r]
                    bits = (mix(mins[:BITS].astype(np.uint64)) & np.uint64(1)).astype(np.uint8).T
                    sketch[full] = np.ascontiguousarray(np.packbits(bits, axis=1)).view(np.int64)
                    ids[full, 0] = np.add.reduceat(flat, cut)
                    ids[full, 1] = np.add.reduceat(mix(flat ^ np.uint64(0x5851F42D4C957F2D)), cut)
                flat_short = pa.array(short.view(np.int64).ravel())
                at = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * (2 * m))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n.astype(np.int64)), pa.array(ids[:, 0].view(np.int64)), pa.array(ids[:, 1].view(np.int64)), *(pa.array(c.copy()) for c in sketch.T), pa.ListArray.from_arrays(at, flat_short)],
                    ["doc_id", "n_shingles", "set1", "set2", *SKETCH, "short"],
                )

    return run


def _sets(size: int):
    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in ranges(offsets, BYTES):
                sets = list(_shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size))
                at = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(at), pa.array(flat))], ["node", "members"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): the smallest node it reaches.

    Each round hooks every node to its smallest neighbour, shortens the chains by pointer
    jumping, and goes on with the edges between different roots.
    """
    edges = durable(edges.select("a", "b").where("a <> b").distinct())
    found = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("root", F.col("node"))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hook = durable(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up")).withColumn("up", F.least("node", "up")))
        while True:
            top = hook.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = durable(hook.join(top, "up").select("node", "up", "top"))
            moving = not jumped.where("up <> top").isEmpty()
            hook = jumped.select("node", F.col("top").alias("up"))
            if not moving:
                break
        renamed = hook.select(F.col("node").alias("root"), "up")
        found = durable(found.join(renamed, "root", "left").select("node", F.coalesce("up", "root").alias("root")))
        left = hook.select(F.col("node").alias("a"), F.col("up").alias("ra"))
        right = hook.select(F.col("node").alias("b"), F.col("up").alias("rb"))
        edges = durable(edges.join(left, "a").join(right, "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
    return found


def _shared(reps: DataFrame, side: int, m: int) -> DataFrame:
    """Per node the short hashes of one collection that another node has too, at most m per text."""
    part = F.slice("short", side * m + 1, m)
    rows = reps.select("node", F.posexplode(part).alias("k", "h"))
    common = rows.groupBy("k", "h").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("k", "h")
    return rows.join(common, ["k", "h"]).groupBy("node").agg(F.collect_list(F.hash(F.lit(side), "k", "h")).alias(f"h{side}"))


def _table_key(a, b):
    """Key of the table of two short hashes, one of each collection."""
    return F.xxhash64(a, b)


def _buckets(pairs: DataFrame) -> DataFrame:
    """(node, key) of every table key that two nodes share: a pair of short hashes, one of each collection."""
    keys = pairs.select("node", F.explode(F.flatten(F.transform("h0", lambda a: F.transform("h1", lambda b: _table_key(a, b))))).alias("key"))
    keyed = durable(keys)
    common = keyed.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
    return keyed.join(common, "key")


def _alike(percent: int):
    """Condition on a pair (columns of it prefixed a_ and b_) that sizes and sketches allow the similarity."""
    differ = sum((F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in SKETCH), F.lit(0))
    return (F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent) & (differ <= DIFFER)


def _named(df: DataFrame, prefix: str, *others: str) -> DataFrame:
    return df.select(*others, *[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c not in others])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the similarity."""
    one = sets.select(F.col("node").alias("a"), F.col("members").alias("ma"))
    two = sets.select(F.col("node").alias("b"), F.col("members").alias("mb"))
    both = F.size(F.array_intersect("ma", "mb"))
    return pairs.join(one, "a").join(two, "b").where(100 * both >= percent * (F.size("ma") + F.size("mb") - both)).select("a", "b").distinct()


def _open(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of the buckets that still hold several components, with ``root`` and the largest component ``major``."""
    rows = buckets.drop("root", "major").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = rows.groupBy("key", "root").agg(F.count("*").alias("n_in"))
    major = sizes.groupBy("key").agg(F.max(F.struct("n_in", "root")).alias("top"), F.count("*").alias("roots")).where("roots > 1")
    return durable(rows.join(major.select("key", F.col("top.root").alias("major")), "key"))


def _prefix_pairs(sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (node, root) with different roots that can reach the similarity.

    The shingles of a set are ordered by rarity among the nodes. Two sets of n1 and n2 shingles
    that are linked have need = ceil(percent * (n1 + n2) / (100 + percent)) in common, so the
    first one they have in common has at least need - 1 behind it in both. In a pair that is
    alike but not linked each set has more shingles of its own than may stand before it; as
    they are rarer than those of the family, such pairs hardly ever meet.
    """
    whole = sets.join(nodes, "node").withColumn("s", F.xxhash64("members")).dropDuplicates(["node", "s"])
    rows = whole.select("node", "s", "root", F.size("members").cast("bigint").alias("n"), F.explode("members").alias("token"))
    counts = rows.groupBy("token").agg(F.count("*").alias("df"), (F.min("root") < F.max("root")).alias("across"))
    place = F.row_number().over(W.partitionBy("node", "s").orderBy("df", "token")) - 1
    ranked = rows.join(counts, "token").withColumn("rest", F.col("n") - place)
    found = ranked.where(f"across and rest * 100 >= n * {percent}").select("token", "node", "root", "n", "rest")
    found = durable(found)
    # nodes of the largest component of a shingle are met by the others, not by each other
    sizes = found.groupBy("token", "root").agg(F.count("*").alias("k"))
    major = sizes.groupBy("token").agg(F.max(F.struct("k", "root")).alias("top"), F.count("*").alias("roots")).where("roots > 1")
    found = durable(found.join(major.select("token", (F.col("top.root")).alias("major")), "token"))
    indexed = found.where(f"rest * {100 + percent} >= n * {2 * percent}")
    shorter = _named(indexed.drop("major"), "b_", "token")
    outer, inner = F.col("root") != F.col("major"), F.col("root") == F.col("major")
    need = (F.col("a_n") + F.col("b_n")) * percent
    may = (F.col("a_root") != F.col("b_root")) & (F.struct("a_n", "a_node") > F.struct("b_n", "b_node")) & (F.least("a_rest", "b_rest") * (100 + percent) >= need)
    one = _named(found.where(outer).drop("major"), "a_", "token").join(shorter, "token").where(may)
    two = _named(found.where(inner).drop("major"), "a_", "token").join(_named(indexed.where(outer).drop("major"), "b_", "token"), "token").where(may)
    pairs = one.select("a_node", "b_node").union(two.select("a_node", "b_node"))
    return pairs.select(F.greatest("a_node", "b_node").alias("a"), F.least("a_node", "b_node").alias("b")).distinct()


def links(docs: DataFrame, m: int = M, r: int = R, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents with equal sets count as one node. Large families are joined first: every node
    is confirmed against one node, the pivot (smallest node) it shares most buckets with; then
    nodes outside a bucket's largest component against a node of that component. What is left
    is whole: nodes of buckets that still hold several components meet across components by
    their rarest shingles, which every link shares (prefix filter), and are confirmed; pairs
    inside a component, and pairs that are alike but too different, are not built.

    A null or blank text has an empty set and is its own component. Repeated rows get the same
    answer; different texts under one doc_id count as linked through that id once either is
    linked to another text. A null doc_id gets the component of its text; where no row with
    that text has an id, component_id is null and the row is kept. Other columns are ignored.
    """
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = f"doc_id bigint, n_shingles bigint, set1 bigint, set2 bigint, {', '.join(f'{c} bigint' for c in SKETCH)}, short array<bigint>"
    with batches_of(docs.sparkSession, ROWS):
        signed = durable(plain.mapInArrow(_signatures(m, r, size), schema))
    key = ["n_shingles", "set1", "set2"]
    named = signed.where("n_shingles > 0 and doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("node"))
    reps = durable(signed.where("n_shingles > 0").withColumnRenamed("doc_id", "node").join(named, [*key, "node"]).dropDuplicates(["node", *key]))
    info = reps.select("node", F.col("n_shingles").alias("n"), *SKETCH)
    short = durable(_shared(reps, 0, m).join(_shared(reps, 1, m), "node"))
    buckets = durable(_buckets(short).join(info, "node"))
    wanted = buckets.select(F.col("node").alias("doc_id")).distinct()
    with batches_of(docs.sparkSession, ROWS):
        sets = durable(plain.join(wanted, "doc_id", "left_semi").mapInArrow(_sets(size), "node bigint, members array<bigint>"))

    one = _named(buckets, "a_", "key")
    pivot = _named(buckets, "b_", "key").groupBy("key").agg(F.min(F.struct("b_node", "b_n", *[f"b_{c}" for c in SKETCH])).alias("p")).select("key", "p.*")
    near = one.join(pivot, "key").where((F.col("a_node") > F.col("b_node")) & _alike(percent))
    best = near.groupBy("a_node", "b_node").agg(F.count("*").alias("n")).groupBy(F.col("a_node").alias("a")).agg(F.max(F.struct("n", -F.col("b_node"))).alias("x"))
    edges = durable(_confirmed(best.select("a", (-F.col("x.col2")).alias("b")), sets, percent))
    roots = components(edges)

    left = _open(buckets, roots)
    pivot = _named(left.where("root = major").drop("root", "major"), "b_", "key").groupBy("key").agg(F.min(F.struct("b_node", "b_n", *[f"b_{c}" for c in SKETCH])).alias("p")).select("key", "p.*")
    near = _named(left.where("root <> major").drop("root", "major"), "a_", "key").join(pivot, "key").where(_alike(percent))
    best = near.groupBy("a_node", "b_node").agg(F.count("*").alias("n")).groupBy(F.col("a_node").alias("a")).agg(F.max(F.struct("n", -F.col("b_node"))).alias("x"))
    edges = durable(edges.union(_confirmed(best.select("a", (-F.col("x.col2")).alias("b")), sets, percent)))
    roots = components(edges)

    nodes = durable(_open(left, roots).select("node", "root").distinct())
    pairs = _prefix_pairs(sets, nodes, percent)
    edges = durable(edges.union(_confirmed(pairs, sets, percent)))
    roots = components(edges)

    out = signed.select("doc_id", *key).join(named, key, "left").join(roots, "node", "left")
    own = F.coalesce("root", "node", "doc_id")
    return out.select("doc_id", "n_shingles", own.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` of which each component keeps one row: its smallest id.

    Rows that share their id with another row, or have none, are told apart by id and text and
    come after rows with an id of their own: equal rows are one, different texts under one id
    are linked by their texts alone. Rows without words all stay, equal ones once.
    """
    doc_id = F.col("doc_id").cast("bigint")
    again = durable(docs.groupBy(doc_id.alias("k")).agg(F.count("*").alias("n")).where("n > 1 or k is null").select("k"))
    if again.isEmpty():
        kept = links(docs, **options).where("kept").select(F.col("doc_id").alias("k"))
        return docs.join(kept, doc_id == F.col("k"), "left_semi")
    width = max(map(len, docs.columns))
    key, repeated, k = ("_" * width + x for x in ("key", "repeated", "k"))  # longer than any name in use
    other = broadcast_if_small(again.select(F.col("k").alias(k), F.lit(True).alias(repeated)))
    own = F.lit(1 << 62) + F.pmod(F.xxhash64(doc_id, F.col("text").cast("string")), F.lit(1 << 62))
    keyed = docs.join(other, doc_id.eqNullSafe(F.col(k)), "left").withColumn(key, F.when(F.col(repeated), own).otherwise(doc_id))
    kept = links(keyed.select(F.col(key).alias("doc_id"), "text"), **options).where("kept").select(F.col("doc_id").alias(k)).distinct()
    rows = keyed.drop(k).join(kept, F.col(key) == F.col(k), "left_semi")
    once = rows.where(F.col(repeated)).dropDuplicates([key])
    return rows.where(F.col(repeated).isNull()).union(once).select(*[F.col(f"`{c}`") for c in docs.columns])
