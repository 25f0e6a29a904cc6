"""Benchmark decontamination: a BM25 inverted index of test items, searched by block-max WAND.

The test items are the indexed side and every passage of every document is a query. Impacts
are divided by an item's own BM25 score, so a score of 1 means that a passage holds all of an
item's words and one threshold serves all items. Every item above the threshold is retrieved
and then verified by the overlap of its question and answer with the passage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from opskit.llm.common import durable, mixed_sequence, ranges, text_bytes, word_hashes

K1, B = 1.2, 0.75
#: Words between passage starts, and of items that are searched with them. A passage has two strides,
#: so every copy of an item lies in one; longer items are searched with strides doubled until they fit.
STRIDE = 96
THRESHOLD = 0.55
#: Shares of the word 3-grams of question and answer that must be in the passage.
QUESTION, ANSWER, GRAM = 0.6, 0.4, 3
#: Words of an index shard. Larger benchmarks are searched shard by shard.
SHARD_WORDS = 500_000
#: Items of a posting block.
BLOCK = 8
#: Terms of more than this share of the items are common: they open a candidate only for items
#: that could reach the threshold by common terms alone.
COMMON = 0.02
#: Postings that are read at once when candidates are looked for.
READ = 1 << 20


def _item_terms(batches):
    """Words of each test item: (item_id, at, term, n, answer_at) with the place of the answer."""
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        heads = [t[: _answer_start(t)] for t in texts]
        h, before = word_hashes(pa.array(texts, pa.string()))
        _, head = word_hashes(pa.array(heads, pa.string()))
        n, q = np.diff(before), np.diff(head)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(batch.column(0).to_pylist(), object), n), pa.int64()), pa.array(np.concatenate([np.arange(x) for x in n]) if len(n) else np.zeros(0, int), pa.int64()), pa.array(h.view(np.int64)), pa.array(np.repeat(n, n), pa.int64()), pa.array(np.repeat(q, n), pa.int64())],
            ["item_id", "at", "term", "n", "answer_at"],
        )


def _answer_start(text: str) -> int:
    """Where the answer begins: after the last line break or sentence end inside the text, or at its end."""
    body = text.rstrip()
    return max(body.rfind("\n"), *(body.rfind(mark, 0, max(0, len(body) - 1)) for mark in (". ", "? ", "! "))) + 1 or len(text)


def index(items: DataFrame, k1: float = K1, b: float = B) -> DataFrame:
    """Rows (item_id, at, term, answer_at, impact): the words of all items in order, durable.

    ``impact`` is the share of the word's term in the item's own BM25 score. Items without a
    word or id are left out; of rows that repeat an item_id all words count as one item's.
    """
    base = items.where("item_id is not null").select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    base = base.groupBy("item_id").agg(F.array_join(F.array_sort(F.collect_set("text")), "\n").alias("text"))
    words = durable(base.mapInArrow(_item_terms, "item_id bigint, at bigint, term bigint, n bigint, answer_at bigint"))
    total = words.where("at = 0").agg(F.count("*").alias("items"), F.avg("n").alias("mean")).first()
    tf = words.groupBy("item_id", "term").agg(F.count("*").alias("tf"), F.first("n").alias("n"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.lit(total["items"]) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    bm25 = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("n") / F.lit(total["mean"])))
    scored = tf.join(df, "term").withColumn("score", bm25)
    own = scored.groupBy("item_id").agg(F.sum("score").alias("own"))
    impact = scored.join(own, "item_id").select("item_id", "term", (F.col("score") / F.col("own")).alias("impact"))
    return durable(words.join(impact, ["item_id", "term"]).select("item_id", "at", "term", "answer_at", "impact"))


class Shard:
    """The postings of a bounded number of items: sorted terms, item numbers, impacts, block maxima."""

    def __init__(self, item_id, at, term, answer_at, impact):
        order = np.lexsort((at, item_id))
        self.items, number = np.unique(item_id[order], return_inverse=True)
        term, impact, answer_at = term[order].view(np.uint64), impact[order], answer_at[order]
        begin = np.searchsorted(number, np.arange(len(self.items) + 1))
        self.words = [term[a:z] for a, z in zip(begin[:-1], begin[1:])]
        self.answer = [int(answer_at[a]) for a in begin[:-1]]
        pair = np.unique(np.stack((term, number.astype(np.uint64)), 1), axis=0, return_index=True)
        self.terms, first = np.unique(pair[0][:, 0], return_index=True)
        self.first = np.append(first, len(pair[0]))
        self.post = pair[0][:, 1].astype(np.int64)
        self.impact = impact[pair[1]]
        self.top = np.maximum.reduceat(self.impact, first) if len(first) else np.zeros(0)
        # block maxima: the blocks of a list are cut by item number, the same cut for every list
        self.blocks = len(self.items) // BLOCK + 1
        size = np.diff(self.first)
        owner = np.repeat(np.arange(len(self.terms)), size)
        key, start = np.unique(owner * self.blocks + self.post // BLOCK, return_index=True)
        self.block_first = np.searchsorted(key, np.arange(len(self.terms) + 1) * self.blocks)
        self.block = key % self.blocks
        self.block_max = np.maximum.reduceat(self.impact, start) if len(start) else np.zeros(0)
        self.common = size > max(3, COMMON * len(self.items))
        self.owner, self.opened = owner, {}

    def _opening(self, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Postings that open candidates (first of each term, item, impact) and the share each item gets without them.

        Rare terms always open. Of an item's common terms the rarest ones open too, until those
        left stay below the threshold together: a passage that reaches it holds an opening term.
        """
        if threshold not in self.opened:
            order = np.lexsort((self.owner, -np.diff(self.first)[self.owner], self.post))  # commonest first, per item
            shared = self.common[self.owner[order]]
            gain = np.where(shared, self.impact[order], 0.0)
            total = np.cumsum(gain)
            begin = np.searchsorted(self.post[order], np.arange(len(self.items)))
            total -= (total - gain)[begin][self.post[order]] if len(order) else 0.0
            closed = np.zeros(len(order), bool)
            closed[order] = shared & (total < threshold - 1e-6)
            rest = np.bincount(self.post[closed], self.impact[closed], minlength=len(self.items))
            keep = ~closed
            first = np.concatenate(([0], np.cumsum(keep)))[self.first]
            self.opened[threshold] = first, self.post[keep], self.impact[keep], rest
        return self.opened[threshold]

    def candidates(self, term: np.ndarray, half: np.ndarray, last: np.ndarray, threshold: float) -> np.ndarray:
        """Passages (named by their first half) that can reach the threshold for some item.

        ``term`` and ``half`` are the known words of all half passages. Only opening postings
        are read; the others count with all they can give an item. A passage counts what opens
        in either of its halves.
        """
        first, post, gain, rest = self._opening(threshold)
        n = len(self.items)
        pair = np.unique(half * len(self.terms) + term)
        half, term = pair // max(1, len(self.terms)), pair % max(1, len(self.terms))
        size = first[term + 1] - first[term]
        half, term, size = half[size > 0], term[size > 0], size[size > 0]
        read = np.cumsum(size)
        out, a = [np.zeros(0, np.int64)], 0
        while a < len(half):  # some halves at once: passages that begin in [half[a], end) and the one before
            b = max(int(np.searchsorted(read, read[a] - size[a] + READ, "right")), int(np.searchsorted(half, half[a], "right")))
            b = int(np.searchsorted(half, half[b - 1], "right")) if b < len(half) else b
            stop = half[b] if b < len(half) else len(last)
            z = int(np.searchsorted(half, stop, "right"))  # the half behind counts for its predecessor
            s, h = size[a:z], half[a:z]
            at = np.repeat(first[term[a:z]], s) + np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s)
            place, item, impact = np.repeat(h, s), post[at], gain[at]
            back = (place > 0) & ~last[place - 1]
            key, where = np.unique(np.concatenate((place * n + item, (place[back] - 1) * n + item[back])), return_inverse=True)
            bound = np.bincount(where, np.concatenate((impact, impact[back])), minlength=len(key)) + rest[key % n]
            out.append(np.unique(key[(bound >= threshold - 1e-9) & (key < stop * n)] // n))
            a = b
        return np.unique(np.concatenate(out))

    def _block_top(self, term: int, block: int) -> float:
        a, z = self.block_first[term], self.block_first[term + 1]
        at = a + int(np.searchsorted(self.block[a:z], block))
        return float(self.block_max[at]) if at < z and self.block[at] == block else 0.0

    def search(self, query: np.ndarray, threshold: float) -> list[int]:
        """All items whose score for the distinct terms ``query`` reaches the threshold (block-max WAND).

        Lists are kept in the order of their current item. The pivot is the first item whose
        lists' maxima reach the threshold; if the maxima of the pivot's blocks do not, all
        lists up to it skip to the next block, otherwise the pivot is scored.
        """
        lists = [[int(self.post[self.first[t]]), int(self.first[t]), int(self.first[t + 1]), t] for t in query.tolist()]
        found, threshold = [], threshold - 1e-9
        top, post, impact = self.top, self.post, self.impact
        while lists:
            lists.sort()
            bound, k = 0.0, -1
            for k, x in enumerate(lists):
                bound += top[x[3]]
                if bound >= threshold:
                    break
            else:
                break
            pivot = lists[k][0]
            while k + 1 < len(lists) and lists[k + 1][0] == pivot:
                k += 1
            block = pivot // BLOCK
            if sum(self._block_top(x[3], block) for x in lists[: k + 1]) < threshold:
                goal = (block + 1) * BLOCK
                if k + 1 < len(lists):
                    goal = min(goal, lists[k + 1][0])
            else:
                goal = pivot + 1
                if sum(impact[p] for item, p, z, t in ((x[0], x[1] + int(np.searchsorted(post[x[1] : x[2]], pivot)), x[2], x[3]) for x in lists[: k + 1]) if p < z and post[p] == pivot) >= threshold:
                    found.append(pivot)
            for x in lists[: k + 1]:
                x[1] += int(np.searchsorted(post[x[1] : x[2]], goal))
                x[0] = int(post[x[1]]) if x[1] < x[2] else -1
            lists = [x for x in lists if x[0] >= 0]
        return found


def _share(grams: np.ndarray, part: np.ndarray) -> float:
    """Share of the 3-grams of ``part`` (the words themselves when fewer) found in the passage."""
    own = np.unique(mixed_sequence(part, min(GRAM, len(part)))) if len(part) else part
    return float(np.isin(own, grams).mean()) if len(own) else 1.0


def _find(shard: Shard, threshold: float, question: float, answer: float, stride: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            text = batch.column(1)
            _, offsets = text_bytes(text)
            rows: list[tuple] = []
            for a, b in ranges(offsets):
                h, before = word_hashes(text.slice(a, b - a))
                at = np.searchsorted(shard.terms, h)
                at[at == len(shard.terms)] = 0
                known = shard.terms[at] == h if len(shard.terms) else np.zeros(len(h), bool)
                n = np.diff(before)
                halves = np.maximum(1, -(-n // stride))
                half0 = np.concatenate(([0], np.cumsum(halves)))
                owner = np.repeat(np.arange(b - a), n)
                half = half0[owner] + (np.arange(len(h)) - before[owner]) // stride
                last = np.zeros(half0[-1], bool)
                last[half0[1:] - 1] = True
                for p in shard.candidates(at[known], half[known], last, threshold).tolist():
                    d = int(np.searchsorted(half0, p, "right")) - 1
                    lo = int(before[d]) + (p - int(half0[d])) * stride
                    hi = min(lo + 2 * stride, int(before[d + 1]))
                    terms = np.unique(at[lo:hi][known[lo:hi]])
                    if shard.top[terms].sum() < threshold - 1e-9:
                        continue
                    grams = None
                    for item in shard.search(terms, threshold):
                        if grams is None:
                            grams = {k: mixed_sequence(h[lo:hi], k) for k in range(1, GRAM + 1)}
                        words, cut = shard.words[item], shard.answer[item]
                        q, r = (_share(grams[min(GRAM, max(1, len(x)))], x) for x in (words[:cut], words[cut:]))
                        if q >= question and r >= answer:
                            rows.append((a + d, int(shard.items[item]), q, r))
            where = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids.take(where), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.float64()), pa.array([r[3] for r in rows], pa.float64())],
                ["doc_id", "item_id", "question_overlap", "answer_overlap"],
            )

    return run


def matches(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, question: float = QUESTION, answer: float = ANSWER, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, item_id, question_overlap, answer_overlap), one row per contaminated pair.

    A null or empty text holds no passage, an item without a word is never found, and repeated
    rows give one pair. Documents with a null id are reported under the id null. The index is
    cut by item length (up to 96 words, 192, 384, ...; passages are twice as long) and into
    shards of at most ``shard_words`` words (one item at least); all documents are searched
    against one shard after another.
    """
    spark = docs.sparkSession
    words = index(items)
    sizes = words.groupBy("item_id").agg(F.count("*").alias("n"))
    running = W.partitionBy("stride", "group").orderBy("item_id").rowsBetween(W.unboundedPreceding, 0)
    # items are dealt to groups by hash, and every group is cut into shards
    groups = max(1, -(-words.count() // (8 * shard_words)))
    stride = (STRIDE * F.pow(F.lit(2.0), F.greatest(F.lit(0.0), F.ceil(F.log2(F.col("n") / STRIDE))))).cast("bigint")
    dealt = sizes.withColumns({"stride": stride, "group": F.pmod(F.xxhash64("item_id"), F.lit(groups))})
    cut = dealt.withColumn("part", F.floor((F.sum("n").over(running) - 1) / shard_words)).select("item_id", "stride", "group", "part")
    placed = durable(words.join(cut, "item_id"))
    out = None
    for g in range(groups):
        here = placed.where(F.col("group") == g)
        for size, part in sorted(here.select("stride", "part").distinct().collect()):
            got = here.where((F.col("stride") == size) & (F.col("part") == part)).select("item_id", "at", "term", "answer_at", "impact").toPandas()
            shard = Shard(*(got[c].to_numpy() for c in ("item_id", "at", "term", "answer_at", "impact")))
            some = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
                _find(shard, threshold, question, answer, size), "doc_id bigint, item_id bigint, question_overlap double, answer_overlap double"
            )
            out = some if out is None else out.union(some)
    if out is None:
        out = spark.createDataFrame([], "doc_id bigint, item_id bigint, question_overlap double, answer_overlap double")
    return out.groupBy("doc_id", "item_id").agg(F.max("question_overlap").alias("question_overlap"), F.max("answer_overlap").alias("answer_overlap"))


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, contaminated, n_items, item_ids (ascending, comma-joined), kept."""
    hits = durable(matches(docs, items, **options))
    # at most as many ids per document as it can hold passages of items
    found = hits.groupBy(F.col("doc_id").alias("_doc")).agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("item_id")), ",").alias("ids"))
    all_docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"))
    n = F.coalesce("n", F.lit(0))
    return all_docs.join(found, F.col("doc_id").eqNullSafe(F.col("_doc")), "left").select("doc_id", (n > 0).alias("contaminated"), n.alias("n_items"), F.coalesce("ids", F.lit("")).alias("item_ids"), (n == 0).alias("kept"))


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without a contaminated pair."""
    hits = durable(matches(docs, items, **options).select(F.col("doc_id").alias("_doc")).distinct())
    return docs.join(hits, docs["doc_id"].cast("bigint").eqNullSafe(hits["_doc"]), "left_anti")
