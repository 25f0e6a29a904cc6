"""Records of several lines, cut out of text files that many tasks read at once.

A file is read by splits. Inside a split the lines are glued to records in the order in which
they are read; only the record that is open at the end of a split, and the lines at its
beginning that belong to an earlier record, leave their task and are joined. Whole records
are never shuffled, so filters on them run in the task that reads them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from opskit.operators.joins import BROADCAST_ROWS, is_small
from opskit.operators.ordered import global_running_sum, running_sum_in
from opskit.session import durable

#: A record inside a split, lines that go on from an earlier split, a record that may go on in the next one.
WHOLE, MORE, OPEN = 0, 1, 2
PIECES = "file string, block bigint, part int, first boolean, text string"


def _parity(batch: pa.RecordBatch, new: np.ndarray, quote: str, still: bool) -> tuple[np.ndarray, np.ndarray]:
    """Whether a quote is open before and behind every line.

    ``new`` marks the first line of every split, whose start is told by the column ``odd``;
    ``still`` is the state behind the line before the batch.
    """
    upto = np.cumsum(pc.count_substring(batch.column("value"), quote).to_numpy().astype(np.int64))
    before = np.concatenate([[0], upto[:-1]])
    at = np.flatnonzero(new)
    start = np.concatenate([[int(still)], batch.column("odd").to_numpy(zero_copy_only=False)[at].astype(np.int64) - before[at]])
    start = start[np.searchsorted(at, np.arange(len(new)), "right")]
    return (before + start) % 2 == 1, (upto + start) % 2 == 1


def _cut(batches: Iterator[pa.RecordBatch], head: str | None, quote: str | None) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("part", pa.int32()), ("first", pa.bool_()), ("text", pa.string())])
    split, lines, begun, first, still = None, [], False, False, True

    def piece(ends_split: bool, still: bool) -> tuple:
        part = MORE if not begun else OPEN if ends_split and still else WHOLE
        return (*split, part, first, "\n".join(lines))

    table = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block, value = (batch.column(c).to_pylist() for c in ("file", "block", "value"))
        place = list(zip(file, block, strict=True))
        new = np.array([s != t for s, t in zip(place, [split, *place[:-1]], strict=True)])
        if quote is None:  # nothing tells whether the last record of a split goes on
            begins, behind = pc.match_substring_regex(batch.column("value"), head).to_numpy(zero_copy_only=False), np.ones(len(value), bool)
        else:
            inside, behind = _parity(batch, new, quote, still)
            begins = ~inside
        edges = np.flatnonzero(begins | new).tolist()
        lines += value[: edges[0] if edges else len(value)]
        out = []
        for i, j in zip(edges, [*edges, len(value)][1:], strict=True):
            if split is not None:
                out.append(piece(bool(new[i]), bool(behind[i - 1]) if i else still))
            split, lines, begun, first = place[i], value[i:j], bool(begins[i]), bool(new[i]) and block[i] == 0
        still = bool(behind[-1])
        if out:
            yield table(out)
    if split is not None:
        yield table([piece(True, still)])


def _open_quotes(lines: DataFrame, quote: str) -> DataFrame:
    """(file, block): the splits that begin inside quotes, from the quotes of all earlier splits."""
    n = F.char_length("value") - F.char_length(F.replace("value", F.lit(quote), F.lit("")))
    per = lines.groupBy("file", "block").agg(F.sum(n).alias("n"))
    upto = running_sum_in(per, ["file"], "n", ["block"], "upto")
    return durable(upto.filter((F.col("upto") - F.col("n")) % 2 == 1).select("file", "block"))


def records(spark: SparkSession, path: str, head: str | None = None, quote: str | None = None, max_open: int = BROADCAST_ROWS) -> DataFrame:
    """Records (text, first) of text files; ``first`` marks the first record of a file.

    A record begins at a line that matches ``head``, or, with ``quote``, at a line before which the
    file holds an even number of quotes. Lines before the first record are left out. The splits
    that begin inside quotes are told to the tasks by a broadcast while they are few (checked),
    else lines are brought together by split.
    """
    reader = spark.read if quote is None else spark.read.option("lineSep", "\n")
    lines = reader.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    if quote is not None:
        inside = _open_quotes(lines, quote).withColumn("odd", F.lit(True))
        if is_small(inside, max_open):
            lines = lines.join(F.broadcast(inside), ["file", "block"], "left")
        else:
            placed = lines.withColumn("pos", F.monotonically_increasing_id()).join(inside, ["file", "block"], "left")
            lines = placed.repartition("file", "block").sortWithinPartitions("file", "block", "pos").drop("pos")
        lines = lines.withColumn("odd", F.coalesce("odd", F.lit(False)))
    pieces = lines.mapInArrow(partial(_cut, head=head, quote=quote), PIECES)
    whole = pieces.filter(F.col("part") == WHOLE).select("text", "first")
    # at most two pieces a split: the record open at its end, and lines of an earlier one at its beginning
    edges = durable(pieces.filter(F.col("part") != WHOLE).withColumn("opens", (F.col("part") == OPEN).cast("bigint")))
    numbered = global_running_sum(edges, "opens", ["file", "block", "part"], "record").filter("record > 0")
    joined = numbered.groupBy("record").agg(F.sort_array(F.collect_list(F.struct("file", "block", "part", "text"))).alias("p"), F.max("first").alias("first"))
    return whole.unionByName(joined.select(F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"), "first"))
