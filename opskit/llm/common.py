"""Durable tables, hold-out rules and vectorised text helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opskit.session import scratch_path

#: Java and Python pattern of a word and of what separates words.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
#: Bytes of text that are worked on at once inside a task.
CHUNK = 1 << 20


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors share."""
    return scratch_path(spark, "llm")


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage is cut."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows for the jobs started inside: texts can be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def hold_batches(spark: SparkSession, rows: int) -> None:
    """Arrow batches of at most ``rows`` rows from here on, for results that are written later."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    spark.conf.set(name, str(min(rows, now) if now > 0 else rows))


def remainder(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the text ''."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def first_share(key: Column | str, wanted: int, rows: Column | int) -> Column:
    """True for about ``2 * wanted`` of ``rows`` rows, chosen by a hash of the key.

    Put before an ordered limit of ``wanted`` rows it bounds what the limit has to gather.
    """
    c = F.col(key) if isinstance(key, str) else key
    place = F.pmod(F.xxhash64(c, F.lit("sample")), F.lit(2**31)) / 2**31
    return place * rows <= 2 * wanted + 100


def words_of(text: Column) -> Column:
    """All words of a text (null: none), as an array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


# -- vectorised text ----------------------------------------------------------------------

_MULT = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_OUTER = np.zeros(256, bool)
_OUTER[[ord(c) for c in "!\"#$%&'()*,-./:;<=>?@[\\]^_`{|}~"]] = True
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, document offsets) of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def ranges(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Consecutive document ranges [a, b) of about ``limit`` bytes, one document at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = b


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, other bytes as they are."""
    return _LOWER[data]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) <= n:
        size = 1 << int(n + 1).bit_length()
        inverse = np.uint64(pow(int(_MULT), -1, 1 << 64))
        for name, base in (("up", _MULT), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any byte range follows; one longer than ``data``."""
    up, _ = _powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes [start, end), equal wherever the bytes are equal."""
    _, down = _powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


def word_ranges(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, words before each document): byte ranges of the words of all documents.

    ``gap`` tells of every byte value whether it separates words.
    """
    solid = ~gap[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin, stop = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1] | edge[1:-1]
    stop[:-1] &= ~solid[1:] | edge[1:-1]
    start = np.flatnonzero(begin)
    return start, np.flatnonzero(stop) + 1, np.searchsorted(start, offsets)


def mixed_sequence(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` neighbouring word hashes (order matters)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + h[k : len(h) - n + 1 + k]
    return mix(out)


def trimmed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, start, end, words before each document) of words in lower case (A-Z) without outer ASCII punctuation."""
    data = lowered(data)
    start, end, before = word_ranges(data, offsets)
    while len(end):
        cut = (end - start > 1) & _OUTER[data[end - 1]]
        if not cut.any():
            break
        end = end - cut
    while len(start):
        cut = (end - start > 1) & _OUTER[data[start]]
        if not cut.any():
            break
        start = start + cut
    return range_hash(prefix_hash(data), start, end), start, end, before


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the trimmed words of a text column, and the words before each document."""
    h, _, _, before = trimmed_words(*text_bytes(column))
    return h, before
