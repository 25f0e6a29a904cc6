"""Vector best-fit packing of tokenised documents into fixed-size sequences.

Tokenising and numbering run on Spark; what is packed is the histogram of piece lengths, which
has at most as many rows as a sequence has tokens, however many documents there are. Pieces of
one length are alike for every constraint (tokens, documents, attention cost), so placing whole
classes gives the bins that best-fit decreasing would give piece by piece.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from opskit.llm.common import durable

CAPACITY = 4096
#: Documents in a sequence, and the sum of squared piece lengths (attention within documents).
MAX_DOCUMENTS = 4096
MAX_ATTENTION = 4096 * 4096
#: Weights of the residual capacities of tokens, documents and attention cost.
WEIGHTS = (1.0, 0.05, 0.05)
END = 1
#: Words, and word cores, kept with their ids in each Python worker.
CACHED_WORDS, CACHED_CORES = 600_000, 900_000
#: Name of the vocabulary file; it drops white space.
TOKENIZER = "word_bpe_49k.json"

#: Documents tokenised at once.
BATCH = 512

_LOADED: dict[str, tuple] = {}
#: Byte-level vocabularies write a byte without a sign of its own as the next free sign from 256 on.
_BYTE_SIGNS = {b: 256 + n for n, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b))}
#: Signs that count as white space for str.split but not for the vocabulary's pattern, and marks
#: that may combine with an ASCII letter before it is lower-cased: such texts are not taken apart.
_ODD = re.compile("[\x1c-\x1f\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]")


def _tokenizer(path: str):
    if path not in _LOADED:
        from tokenizers import Tokenizer

        _LOADED[path] = (Tokenizer.from_file(path), {}, {})
    return _LOADED[path]


def token_bytes(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit numbers, without the final id.

    The vocabulary lower-cases, drops white space and never joins across it, nor letters with
    the punctuation behind them. So a text's ids are those of its words one after another, and
    of a word those of its letters and of the full stops or commas at its end; each distinct
    core is tokenised once per worker while the cache lasts.
    """
    tokenizer, words, cores = _tokenizer(path)
    if len(words) > CACHED_WORDS:
        words.clear()
    if len(cores) > CACHED_CORES:
        cores.clear()
    split = [[t] if _ODD.search(t) else t.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass").split() for t in texts]
    new = set().union(*split).difference(words)
    parts = {}
    for w in new:
        core = w.rstrip(".,")
        parts[w] = (core, w[len(core) :]) if core and core[-1].isalpha() else (w, "")
    for core in {c for pair in parts.values() for c in pair if c not in cores}:
        ids = None
        if core.isalpha():
            plain = core if core.isascii() else tokenizer.normalizer.normalize_str(core)
            if plain.isalpha():  # one pre-token: the merges alone remain
                ids = [t.id for t in tokenizer.model.tokenize(plain if plain.isascii() else plain.encode().decode("latin-1").translate(_BYTE_SIGNS))]
        if ids is None:
            ids = tokenizer.encode(core, add_special_tokens=False).ids
        cores[core] = array("I", ids).tobytes()
    for w, (core, rest) in parts.items():
        words[w] = cores[core] + cores[rest] if rest else cores[core]
    return [b"".join(map(words.__getitem__, some)) for some in split]


def pieces(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every document's pieces.

    A document is its ids and a final id 1; null text counts as empty. Only documents longer
    than ``capacity`` are cut. Repeated rows are packed as often as they occur.
    """
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path(TOKENIZER)
    final = np.array([END], "<u4").tobytes()
    size = 4 * capacity

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for at in range(0, len(texts), BATCH):
                rows: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
                raw = []
                for doc_id, data in zip(ids[at : at + BATCH], token_bytes(texts[at : at + BATCH], tokenizer_path)):
                    data += final
                    for k, a in enumerate(range(0, len(data), size)):
                        part = data[a : a + size]
                        for name, value in zip(rows, (doc_id, k, a // 4, len(part) // 4, zlib.crc32(part))):
                            rows[name].append(value)
                        raw.append(part)
                out = [pa.array(rows["doc_id"], pa.int64()), pa.array(rows["piece"], pa.int32()), *(pa.array(rows[c], pa.int64()) for c in ("start", "length", "ids_crc32"))]
                if keep_ids:
                    out.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in raw], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(out, [*rows, *["ids"] * keep_ids])

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def best_fit(
    histogram: dict[int, int], capacity: int = CAPACITY, max_documents: int = MAX_DOCUMENTS, max_attention: int = MAX_ATTENTION,
    weights: tuple[float, float, float] = WEIGHTS, rule: str = "norm",
) -> list[tuple[int, list[int]]]:
    """Bins as (how many alike, piece lengths in order), by vector best-fit decreasing.

    Lengths are placed from the longest down. Among the bin kinds that respect every
    constraint, ``rule="norm"`` takes the least weighted norm of the residual capacities
    after placing, ``rule="dot"`` the least weighted dot product of demand and residual.
    """
    caps = np.array([capacity, max_documents, max_attention], float)
    w = np.array(weights)
    left = np.zeros((64, 3))  # residual capacities of each bin kind
    many = np.zeros(64, np.int64)
    content: list[tuple] = []  # (content before, length, how often), linked
    free: list[int] = []

    def put(residual, count, what):
        nonlocal left, many
        if free:
            at = free.pop()
            content[at] = what
        else:
            at = len(content)
            content.append(what)
            if at == len(many):
                left, many = np.concatenate((left, np.zeros_like(left))), np.concatenate((many, np.zeros_like(many)))
        left[at], many[at] = residual, count

    for length in sorted(histogram, reverse=True):
        count, need = histogram[length], np.array([length, 1, length * length], float)
        if length > capacity or need[2] > max_attention or max_documents < 1:
            raise ValueError(f"a piece of {length} tokens fits no empty bin")
        while count:
            n = len(content)
            fits = np.flatnonzero((many[:n] > 0) & (left[:n] >= need).all(axis=1))
            if not len(fits):
                # new bins, each filled with as many of this length as it takes
                each = int(min(capacity // length, max_documents, max_attention // (length * length)))
                full, rest = divmod(count, each)
                if full:
                    put(caps - each * need, full, ((), length, each))
                if rest:
                    put(caps - rest * need, 1, ((), length, rest))
                break
            after = (left[fits] - need) / caps
            cost = ((w * after) ** 2).sum(axis=1) if rule == "norm" else (w * (need / caps) * (left[fits] / caps)).sum(axis=1)
            # a bin that was the best choice stays it while it fits: fill the bins one by one
            at = int(fits[np.lexsort((fits, cost))[0]])
            each = int((left[at] // need).min())
            full = min(int(many[at]), count // each)
            rest = count - full * each if full < many[at] else 0
            residual, before = left[at].copy(), content[at]
            many[at] -= full + (rest > 0)
            if not many[at]:
                free.append(at)
            if full:
                put(residual - each * need, full, (before, length, each))
            if rest:
                put(residual - rest * need, 1, (before, length, rest))
            count -= full * each + rest
    out = []
    for at in np.flatnonzero(many[: len(content)]):
        lengths, node = [], content[at]
        while node:
            node, length, times = node
            lengths[:0] = [length] * times
        out.append((int(many[at]), lengths))
    return out


def place(found: DataFrame, capacity: int = CAPACITY, **limits) -> DataFrame:
    """``found`` (columns length, doc_id, piece, ...) plus sequence_id and offset.

    Pieces of a length are numbered by partition and place in it; the k-th piece of a length
    takes the k-th slot of that length. The slot table depends on the lengths only.
    """
    spark = found.sparkSession
    numbered = durable(found.withColumn("_mid", F.monotonically_increasing_id()))
    task = F.shiftright("_mid", 33)
    counts = durable(numbered.groupBy("length", task.alias("_task")).agg(F.count("*").alias("_n")))
    histogram = {int(r.length): int(r.n) for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most ``capacity`` rows
    bins = sorted(best_fit(histogram, capacity, **limits), key=lambda x: (x[1], x[0]), reverse=True)
    # slots: (length, first rank, ranks, sequence of the first, places of this length per sequence, offsets)
    slots, taken, sequence = [], dict.fromkeys(histogram, 0), 0
    for many, lengths in bins:
        offset, at = 0, {}
        for length in lengths:
            at.setdefault(length, []).append(offset)
            offset += length
        for length, offsets in at.items():
            slots.append((length, taken[length], sequence, len(offsets), offsets[0]))
            taken[length] += many * len(offsets)
        sequence += many
    schema = "length bigint, first bigint, sequence bigint, each bigint, offset bigint"
    table = spark.createDataFrame(slots, schema)
    before = W.partitionBy("length").orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("length", "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy("length", "_task").orderBy("_mid")
    ranked = (
        numbered.withColumn("_task", task)
        .withColumn("_inside", F.row_number().over(inside) - 1)
        .join(starts, ["length", "_task"])
        .withColumn("_rank", F.col("_before") + F.col("_inside"))
    )
    # per length one sorted array of slots: at most one entry per bin kind
    lists = table.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("first", "sequence", "each", "offset"))).alias("_slots"))
    joined = ranked.join(F.broadcast(lists), "length")  # bounded by the number of bin kinds
    return _looked_up(joined)


def _looked_up(joined: DataFrame) -> DataFrame:
    """Binary search of _rank among the first ranks of _slots, in SQL."""
    lo = F.aggregate(
        F.sequence(F.lit(1), F.ceil(F.log2(F.size("_slots") + 1)).cast("int")),
        F.struct(F.lit(0).alias("lo"), F.size("_slots").alias("hi")),  # slots[lo].first <= rank < slots[hi].first
        lambda acc, _: F.when(acc["hi"] - acc["lo"] <= 1, acc).otherwise(
            F.when(
                F.get(F.col("_slots"), F.floor((acc["lo"] + acc["hi"]) / 2).cast("int"))["first"] <= F.col("_rank"),
                F.struct(F.floor((acc["lo"] + acc["hi"]) / 2).cast("int").alias("lo"), acc["hi"].alias("hi")),
            ).otherwise(F.struct(acc["lo"].alias("lo"), F.floor((acc["lo"] + acc["hi"]) / 2).cast("int").alias("hi")))
        ),
        lambda acc: acc["lo"],
    )
    slot = joined.withColumn("_slot", F.get(F.col("_slots"), lo)).drop("_slots")
    place = F.col("_rank") - F.col("_slot.first")
    return (
        slot.withColumn("sequence_id", F.col("_slot.sequence") + F.expr("(_rank - _slot.first) div _slot.each"))
        .withColumn("offset", F.col("_slot.offset") + (place % F.col("_slot.each")) * F.col("length"))
        .drop("_slot", "_rank", "_before", "_inside", "_task", "_mid")
    )


def pack(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False, **limits) -> DataFrame:
    """Pieces of all documents with their sequence and offset (see ``pieces`` and ``place``)."""
    out = place(pieces(docs, tokenizer_path, capacity, keep_ids), capacity, **limits)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * keep_ids)
