"""Exact substring dedup: deep-shallow suffix sorting of the places where repeats are possible.

Every 400-byte string contains grams, and equal strings contain the same gram with the
smallest hash, their anchor. Neighbouring strings with one anchor form a segment, so segments
of one anchor are the only places where a string of theirs can occur again. The segments of
repeated anchors are brought together, in one shuffle of their bytes. Copies of a segment are
counted, the suffixes of different ones are sorted to the length of a string: multikey
quicksort (by 8-byte words) down to a shallow depth, then a blind trie for every group with a
longer common prefix. Anchors with many segments are counted before any bytes move.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opskit.llm.common import durable, hold_batches, prefix_hash, range_hash, ranges, text_bytes

LENGTH = 400
#: Gram lengths. Anchors with more than GROUP different segments are cut again by longer grams,
#: at last by whole strings, so that no group grows with the data.
GRAMS = (64, 232, 316, 400)
GROUP = 256
#: Least and most bits of a filter that every task gets (4 to 32 MB, 16 bits or more a hash between).
#: Filters only spare segments and texts that cannot matter from being shuffled; what passes one
#: wrongly is sorted or joined and found single.
FILTER_BITS, MOST_BITS = 1 << 25, 1 << 28
#: Bytes that are worked on at once inside a task (some hundred bytes of hashes and places for each)
#: and rows in an Arrow batch, so that Python workers stay small beside the heap.
CHUNK = 1 << 18
BATCH_ROWS = 1000
#: Bytes that are compared by multikey quicksort before blind tries take over.
SHALLOW = 32


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: block prefixes and suffixes meet (linear time)."""
    n = len(h) - width + 1
    blocks = -(-len(h) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(h)] = h
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def _own_repeats(prefix: np.ndarray, h: np.ndarray, lowest: np.ndarray, begin: np.ndarray, end: np.ndarray, gram: int, length: int) -> np.ndarray:
    """True for segments that hold a string twice (periodic text): their anchor's gram lies at two places."""
    own = np.zeros(len(begin), bool)
    if gram >= length or not len(begin):
        return own
    # a repeated string puts its anchor's gram at places that are first or last in a window, with no other lowest gram between
    width = length - gram + 1
    lows = np.zeros(len(h), bool)
    lows[: len(lowest)] = h[: len(lowest)] == lowest
    lows[width - 1 :] |= h[width - 1 :] == lowest
    at = np.flatnonzero(lows)
    pair = np.flatnonzero(h[at[1:]] == h[at[:-1]])
    if not len(pair):
        return own
    left, right = at[pair], np.append(at[pair + 1], len(h))
    own = right[np.searchsorted(left, begin)] <= end - gram
    some = np.flatnonzero(own)
    n = end[some] - length - begin[some] + 1
    segment = np.repeat(np.arange(len(some)), n)
    start = begin[some][segment] + np.arange(len(segment)) - np.repeat(np.cumsum(n) - n, n)
    string = range_hash(prefix, start, start + length)
    order = np.lexsort((string, segment))
    twice = (string[order][1:] == string[order][:-1]) & (segment[order][1:] == segment[order][:-1])
    own[some] = np.bincount(segment[order][1:][twice], minlength=len(some)) > 0
    return own


def segments(data: np.ndarray, offsets: np.ndarray, gram: int, length: int = LENGTH):
    """(document, start, end, anchor, content hash, own) of all segments of a chunk; ``own``: a string occurs in it twice."""
    starts = np.arange(len(data) - length + 1) if len(data) >= length else np.zeros(0, np.int64)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, bool),)
    prefix = prefix_hash(data)
    grams = np.arange(len(data) - gram + 1)
    h = range_hash(prefix, grams, grams + gram)
    lowest = _sliding_min(h, length - gram + 1)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = doc[: len(starts)] == doc[length - 1 :]  # strings inside one document
    new = np.ones(len(starts), bool)
    new[1:] = (lowest[1:] != lowest[:-1]) | (whole[1:] != whole[:-1]) | (doc[1 : len(starts)] != doc[: len(starts) - 1])
    # long runs (periodic text) are cut, at whole-string grams every string stands alone
    begin = np.flatnonzero(new)
    run = starts - np.repeat(begin, np.diff(np.append(begin, len(starts))))
    new |= run % max(1, length - gram) == 0
    begin = np.flatnonzero(new & whole)
    stop = np.append(np.flatnonzero(new), len(starts))
    end = stop[np.searchsorted(stop, begin, "right")] - 1 + length
    at = doc[begin]
    own = _own_repeats(prefix, h, lowest, begin, end, gram, length)
    return at, begin - offsets[at], end - offsets[at], lowest[begin], range_hash(prefix, begin, end), own


META = "doc_id bigint, _text bigint, start int, anchor bigint, weight bigint, own boolean"
COUNTED, CARVED = f"{META}, end int, content bigint", f"{META}, bytes binary"


def _anchors(gram: int, length: int):
    """(anchor, weight) of every segment of the pieces; a string that a segment holds twice counts once more."""

    def run(batches):
        for batch in batches:
            data, offsets = _binary(batch.column(4))
            for a, b in ranges(offsets, CHUNK):
                doc, _, _, anchor, _, own = segments(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], gram, length)
                weight = batch.column(3).to_numpy(zero_copy_only=False)[a + doc] + own
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(weight, pa.int64())], ["anchor", "weight"])

    return run


def _bits(hashes: DataFrame, column: str) -> np.ndarray:
    """The words of a filter of the hashes, however many there are. They are read twice."""
    bits = max(FILTER_BITS, min(MOST_BITS, 1 << (16 * hashes.count()).bit_length()))
    bit = F.expr(f"cast({column} & {bits - 1} as int)")
    # at most bits / 32 rows, which go to the driver as a few byte strings
    rows = hashes.select(bit.alias("bit")).groupBy(F.shiftrightunsigned("bit", 5).alias("word")).agg(F.expr("bit_or(shiftleft(1, bit & 31))").alias("marks"))

    def joined(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([c.to_numpy(zero_copy_only=False).astype(np.int32).tobytes()], pa.binary()) for c in batch.columns], batch.schema.names)

    words = np.zeros(bits // 32, np.uint32)
    for at, marks in rows.mapInArrow(joined, ", ".join(f"{c} binary" for c in rows.columns)).collect():
        words[np.frombuffer(at, np.int32)] = np.frombuffer(marks, np.uint32)
    return words


def _marked(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes pass a filter."""
    bit = hashes.view(np.uint64) & np.uint64(32 * len(words) - 1)
    return (words[bit >> np.uint64(5)] >> (bit & np.uint64(31)).astype(np.uint32)) & np.uint32(1) > 0


def _passing(words: np.ndarray, column: str, passing: bool = True):
    """Rows whose hash in ``column`` passes the filter, or does not."""

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_marked(words, batch.column(column).to_numpy(zero_copy_only=False)) == passing))

    return run


def _cut(gram: int, length: int, wanted: np.ndarray, unwanted: np.ndarray | None, bytes_too: bool):
    """Segments of pieces (doc_id, _text, offset, weight, bytes) whose anchor passes the filters."""

    def run(batches):
        for batch in batches:
            data, offsets = _binary(batch.column(4))
            base = batch.column(2).to_numpy(zero_copy_only=False)
            for a, b in ranges(offsets, CHUNK):
                raw, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                found = segments(raw, at, gram, length)
                keep = _marked(wanted, found[3])
                if unwanted is not None:
                    keep &= ~_marked(unwanted, found[3])
                keep = np.flatnonzero(keep)
                for k in range(0, len(keep), 4096):
                    doc, start, end, anchor, content, own = (x[keep[k : k + 4096]] for x in found)
                    rows = pa.array(a + doc)
                    shift = base[a + doc]
                    columns = {"doc_id": batch.column(0).take(rows), "_text": batch.column(1).take(rows), "start": pa.array((start + shift).astype(np.int32)), "anchor": pa.array(anchor.view(np.int64)), "weight": batch.column(3).take(rows), "own": pa.array(own)}
                    if bytes_too:
                        columns["bytes"] = pa.array([raw[x:y].tobytes() for x, y in zip(at[doc] + start, at[doc] + end)], pa.binary())
                    else:
                        columns |= {"end": pa.array((end + shift).astype(np.int32)), "content": pa.array(content.view(np.int64))}
                    yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _binary(column: pa.Array):
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        return text_bytes(column)
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


# -- deep-shallow sorting -----------------------------------------------------------------


class BlindTrie:
    """Orders strings of one length by their bytes; inner nodes keep only a depth and the next byte.

    A string descends by single bytes to some leaf, is compared with that leaf once, and is
    put in where the comparison found the first difference.
    """

    def __init__(self, data: bytes, length: int):
        self.data, self.length, self.root = data, length, None

    def insert(self, at: int) -> None:
        data, length = self.data, self.length
        if self.root is None:
            self.root = [at]
            return
        node = self.root
        while isinstance(node, tuple):
            depth, children = node
            node = children.get(data[at + depth]) or next(iter(children.values()))
        other = node[0]
        mine, its = data[at : at + length], data[other : other + length]
        if mine == its:
            node.append(at)
            return
        differ = int.from_bytes(mine, "big") ^ int.from_bytes(its, "big")
        lcp = length - (differ.bit_length() + 7) // 8
        above, node = None, self.root
        while isinstance(node, tuple) and node[0] < lcp:
            above, node = node, node[1][data[at + node[0]]]
        if isinstance(node, tuple) and node[0] == lcp:
            node[1][mine[lcp]] = [at]
            return
        branch = (lcp, {its[lcp]: node, mine[lcp]: [at]})
        if above is None:
            self.root = branch
        else:
            above[1][mine[above[0]]] = branch

    def ordered(self) -> list[list[int]]:
        """Groups of equal strings, in byte order."""
        out, stack = [], [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack += [node[1][c] for c in sorted(node[1], reverse=True)]
            else:
                out.append(node)
        return out


def sorted_groups(data: bytes, at: np.ndarray, owner: np.ndarray, length: int = LENGTH, shallow: int = SHALLOW):
    """Groups of at least two equal strings data[p:p+length], p in ``at``, within each owner.

    Multikey quicksort works on all owners at once: the strings are ordered by one 8-byte word
    after another, and only groups that are still equal go on. Before the tries, groups are
    parted by their last word as well, because only equal strings matter.
    """
    raw = np.frombuffer(data, np.uint8)
    if len(raw) < 8 or not len(at):
        return
    words = np.ndarray((len(raw) - 7,), ">u8", buffer=data, strides=(1,))
    depths = [*range(0, min(shallow, length - 7), 8), length - 8] if length >= 8 else []
    group = owner.astype(np.int64)
    for depth in depths:
        key = words[at + depth].astype(np.uint64)
        order = np.lexsort((key, group))
        at, group, key = at[order], group[order], key[order]
        edge = np.ones(len(at) + 1, bool)
        edge[1:-1] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        alone = edge[1:] & edge[:-1]
        group = np.cumsum(edge[:-1])
        at, group = at[~alone], group[~alone]
        if not len(at):
            return
    edge = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True]))).tolist()
    places = at.tolist()
    for a, b in zip(edge[:-1], edge[1:]):
        trie = BlindTrie(data, length)
        for p in places[a:b]:
            trie.insert(p)
        yield from (g for g in trie.ordered() if len(g) > 1)


def _group_spans(rows: pa.RecordBatch, length: int) -> pa.RecordBatch:
    """Repeated spans of the segments of whole anchors (rows in the order of anchors)."""
    data, offsets = _binary(rows.column(6))
    anchor, weight, own = (rows.column(i).to_numpy(zero_copy_only=False) for i in (3, 4, 5))
    size = np.diff(offsets)
    content = range_hash(prefix_hash(data), offsets[:-1], offsets[1:])
    # copies of a segment: each is a span, the first one stands for them
    order = np.lexsort((size, content, anchor))
    new = np.ones(len(order), bool)
    new[1:] = (anchor[order][1:] != anchor[order][:-1]) | (content[order][1:] != content[order][:-1]) | (size[order][1:] != size[order][:-1])
    kind = np.cumsum(new) - 1
    total = np.bincount(kind, weight[order])
    first = order[new]
    copied = order[total[kind] > 1]
    # anchors with several segments, or strings twice in one, at least one segment of which occurs once
    group = np.cumsum(np.concatenate(([False], anchor[first][1:] != anchor[first][:-1])))
    single = np.bincount(group, total == 1) > 0
    several = (np.bincount(group) > 1) | (np.bincount(group, own[first]) > 0)
    chosen = (single & several)[group]
    segs, owners, once = first[chosen], group[chosen], total[chosen] == 1
    n = np.maximum(0, size[segs] - length + 1)
    segment = np.repeat(np.arange(len(segs)), n)
    place = offsets[segs][segment] + np.arange(len(segment)) - np.repeat(np.cumsum(n) - n, n)
    raw = data.tobytes()
    hit = np.zeros(len(raw) + 1, bool)
    for found in sorted_groups(raw, place, owners[segment], length):
        hit[found] = True
    # maximal runs of covered bytes, cut at the borders of segments
    marks = np.zeros(len(raw) + length + 1, np.int32)
    on = np.flatnonzero(hit)
    np.add.at(marks, on, 1)
    np.add.at(marks, on + length, -1)
    inside = np.concatenate(([False], np.cumsum(marks)[: len(raw)] > 0, [False]))
    opens = inside[1:] & ~inside[:-1]
    opens[offsets[:-1][size > 0]] |= inside[1:][offsets[:-1][size > 0]]
    closes = inside[:-1] & ~inside[1:]
    closes[offsets[1:][size > 0]] |= inside[:-1][offsets[1:][size > 0]]
    x, y = np.flatnonzero(opens), np.flatnonzero(closes)
    seg = np.searchsorted(offsets, x, "right") - 1
    wanted = np.zeros(len(size), bool)
    wanted[segs[once]] = True
    x, y, seg = x[wanted[seg]], y[wanted[seg]], seg[wanted[seg]]
    base = rows.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
    take = np.concatenate((copied, seg))
    start = np.concatenate((base[copied], base[seg] + x - offsets[seg]))
    end = np.concatenate((base[copied] + size[copied], base[seg] + y - offsets[seg]))
    at = pa.array(take)
    return pa.RecordBatch.from_arrays([rows.column(0).take(at), rows.column(1).take(at), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], ["doc_id", "_text", "start", "end"])


def _sort(length: int):
    """Repeated spans from carved segments in the order of their anchors."""

    def run(batches):
        rest = None
        for batch in batches:
            if rest is not None and rest.num_rows:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            anchor = batch.column(3).to_numpy(zero_copy_only=False)
            edge = np.append(np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1]))), len(anchor))
            _, offsets = _binary(batch.column(6))
            # the last anchor may go on in the next batch
            for a, b in ranges(offsets[edge[:-1]], CHUNK):
                yield _group_spans(batch.slice(edge[a], edge[b] - edge[a]), length)
            rest = batch.slice(edge[-2])
        if rest is not None and rest.num_rows:
            yield _group_spans(rest, length)

    return run


# -- the whole table ----------------------------------------------------------------------

SPANS = "doc_id bigint, _text bigint, start int, end int"


def _same_doc(left: str, right: str):
    return F.col(f"{left}doc_id").eqNullSafe(F.col(f"{right}doc_id")) & (F.col(f"{left}_text") == F.col(f"{right}_text"))


def _level(pieces: DataFrame, texts: DataFrame, gram: int, length: int, group: int) -> tuple[list[DataFrame], DataFrame | None]:
    """Repeated spans among ``pieces`` and the segments of anchors with too many of them (as pieces)."""
    counts = durable(pieces.mapInArrow(_anchors(gram, length), "anchor bigint, weight bigint").groupBy("anchor").agg(F.sum("weight").alias("n")).where("n > 1"))
    large = _bits(counts.where(f"n > {group if gram < length else 1}"), "anchor")
    out = []
    if gram < length:
        carved = pieces.mapInArrow(_cut(gram, length, _bits(counts, "anchor"), large, True), CARVED)
        out.append(carved.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_sort(length), SPANS))
    if not large.any():
        return out, None
    meta = durable(pieces.mapInArrow(_cut(gram, length, large, None, False), COUNTED))
    size = F.col("end") - F.col("start")
    alike = durable(meta.groupBy("anchor", "content", size.alias("size")).agg(F.sum("weight").alias("weight"), F.max("own").alias("own"), F.min(F.struct("doc_id", "_text", "start", "end")).alias("rep")))
    copied = alike.where("weight > 1").select("anchor", "content", "size")
    out.append(meta.withColumn("size", size).join(copied, ["anchor", "content", "size"]).select("doc_id", "_text", "start", "end"))
    if gram >= length:
        return out, None
    # anchors with several segments or strings twice in one, at least one segment of which occurs once
    groups = alike.groupBy("anchor").agg(F.count("*").alias("segments"), F.min("weight").alias("least"), F.max("own").alias("own")).where("(segments > 1 or own) and least = 1").select("anchor")
    open_ = alike.join(groups, "anchor").select("weight", "rep.*")
    # at most the segments of one document in a list; rows alike in id and text are carved once
    wanted = durable(open_.groupBy(F.col("doc_id").alias("w_doc_id"), F.col("_text").alias("w__text")).agg(F.collect_list(F.struct("weight", "start", "end")).alias("cuts")))
    # texts without such a segment are not shuffled
    asked = _bits(wanted.select(F.xxhash64("w_doc_id", "w__text").alias("row")), "row")
    own = texts.withColumn("row", F.xxhash64("doc_id", "_text"))
    rows = _carved(own.mapInArrow(_passing(asked, "row"), own.schema).join(wanted, _same_doc("", "w_")))
    return out, durable(rows.dropDuplicates(["doc_id", "_text", "offset", "size"]).drop("size"))


def _carved(rows: DataFrame) -> DataFrame:
    """The bytes of every wanted segment."""

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            cuts = batch.column(3)
            items = cuts.flatten()
            doc = np.repeat(np.arange(len(cuts)), np.diff(cuts.offsets.to_numpy()))
            names = [f.name for f in items.type]
            start, end = (items.field(names.index(c)).to_numpy(zero_copy_only=False) for c in ("start", "end"))
            for a in range(0, len(doc), 8192):
                b = min(a + 8192, len(doc))
                cut = [data[offsets[d] + s : offsets[d] + e].tobytes() for d, s, e in zip(doc[a:b], start[a:b], end[a:b])]
                rows = pa.array(doc[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(start[a:b]), items.field(names.index("weight")).slice(a, b - a), pa.array(cut, pa.binary()), pa.array(end[a:b] - start[a:b])],
                    ["doc_id", "_text", "offset", "weight", "bytes", "size"],
                )

    schema = "doc_id bigint, _text bigint, offset int, weight bigint, bytes binary, size int"
    return rows.select("doc_id", "_text", "text", "cuts").mapInArrow(run, schema)


def repeated_spans(docs: DataFrame, length: int = LENGTH, grams: tuple[int, ...] = GRAMS, group: int = GROUP) -> DataFrame:
    """(doc_id, _text, start, end): byte spans covered by strings of ``length`` that occur elsewhere.

    Spans may overlap. Rows alike in id and text are copies of each other.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null").withColumn("_text", F.xxhash64("text")).select("doc_id", "_text", "text")
    pieces = texts.select("doc_id", "_text", F.lit(0).alias("offset"), F.lit(1).cast("bigint").alias("weight"), F.col("text").alias("bytes"))
    out = []
    for gram in grams:
        found, pieces = _level(pieces, texts, gram, length, group)
        out += found
        if pieces is None or pieces.isEmpty():
            break
    spans = out[0]
    for more in out[1:]:
        spans = spans.unionByName(more)
    return spans


def _removed(batches):
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        spans = batch.column(2).to_pylist()
        rows = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
        for i, found in enumerate(spans):
            text = data[offsets[i] : offsets[i + 1]].tobytes()
            left, done, removed, runs = [], 0, 0, 0
            last = -1
            for s in sorted(found or [], key=lambda x: (x["start"], x["end"])):
                a, b = s["start"], s["end"]
                if a > last:
                    left.append(text[done:a])
                    runs += 1
                    removed += b - a
                    done = last = b
                elif b > last:
                    removed += b - last
                    done = last = b
            left.append(text[done:])
            rest = b"".join(left)
            for name, value in zip(rows, (len(text), removed, runs, hashlib.sha256(rest).hexdigest(), rest)):
                rows[name].append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(rows[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")), pa.array(rows["kept_sha256"], pa.string()), pa.array(rows["kept"], pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def deduplicate(docs: DataFrame, length: int = LENGTH, grams: tuple[int, ...] = GRAMS, group: int = GROUP) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, kept (bytes).

    Every byte covered by a ``length``-byte string that also starts anywhere else is removed,
    all copies alike. A null text counts as empty; shorter texts lose nothing; other columns
    are ignored. The kept bytes may cut a code point, so they are given as binary.
    """
    hold_batches(docs.sparkSession, BATCH_ROWS)
    spans = durable(repeated_spans(docs, length, grams, group))
    # at most two spans per segment of the document
    per = spans.groupBy(F.col("doc_id").alias("w_doc_id"), F.col("_text").alias("w__text")).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text")).withColumn("_text", F.xxhash64("text"))
    touched = _bits(spans.select("_text").distinct(), "_text")
    schema = "doc_id bigint, text string, _text bigint"
    # texts without a span are not shuffled
    whole = plain.mapInArrow(_passing(touched, "_text", False), schema).select("doc_id", "text", F.lit(None).cast("array<struct<start:int,end:int>>").alias("spans"))
    rows = plain.mapInArrow(_passing(touched, "_text"), schema).join(per, _same_doc("", "w_"), "left").select("doc_id", "text", "spans")
    return whole.unionByName(rows).mapInArrow(_removed, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
