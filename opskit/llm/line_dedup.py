"""Line dedup by a suffix array over line-ID sequences, in DataFrame functions only.

Lines that occur once cannot be part of a repeated run, so the sequences consist of the
repeated lines. Prefix doubling gives every suffix its rank among the suffixes cut to 1, 2,
4, ... lines; ranks follow the sort order of the cut suffixes, and suffixes that became unique
drop out. Suffixes that share their first n lines form an LCP interval of depth n: they are
those with equal ranks, at the largest power of two up to n, of their first and of their last
lines. A run of lines is deleted where its interval holds an earlier copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from opskit.llm.common import durable, words_of

#: Words of the shortest run that is deleted.
MIN_WORDS = 50

DOC = ["_doc", "_text"]


def _keyed(docs: DataFrame) -> DataFrame:
    """Columns _doc and _text identify a document: rows alike in id and text are one."""
    return docs.withColumns({"_doc": F.col("doc_id"), "_text": F.xxhash64("text")})


def _lines(docs: DataFrame) -> DataFrame:
    """(document, j, line, words, name) of all lines with a word; j counts these lines."""
    rows = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line"), x.alias("x"), F.size(words_of(x)).alias("words")))
    solid = F.filter(rows, lambda r: r["words"] > 0)
    out = _keyed(docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")).select(*DOC, F.posexplode(solid).alias("j", "r"))
    return out.select(*DOC, "j", "r.line", "r.words", F.xxhash64("r.x").alias("n1"), F.xxhash64(F.lit("line"), F.col("r.x")).alias("n2"))


def _ranked(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows whose ``by`` occurs at two places, with its rank ``r`` in the order of ``by``."""
    at = F.struct(*DOC, "j")
    common = rows.groupBy(*by).agg(F.min(at).alias("lo"), F.max(at).alias("hi")).where("lo < hi").select(*by)
    ranks = durable(common.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("r", F.monotonically_increasing_id()))
    return rows.join(ranks, by).drop(*by)


def _ranks(lines: DataFrame, longest: int) -> tuple[DataFrame, DataFrame]:
    """(repeated lines, ranks (document, j, k, r) of repeated suffixes cut to 2**k lines)."""
    # rows alike in id and text are one; a line that only they hold is not repeated
    first = durable(_ranked(lines, ["n1", "n2"]).dropDuplicates([*DOC, "j"]))
    level, k = first.select(*DOC, "j", "r"), 0
    found = level.withColumn("k", F.lit(0))
    while 2 ** (k + 1) <= longest:
        ahead = W.partitionBy(*DOC).orderBy("j").rangeBetween(2**k, 2**k)
        pairs = level.withColumn("b", F.first("r").over(ahead)).where("b is not null").withColumnRenamed("r", "a")
        level, k = durable(_ranked(pairs, ["a", "b"])), k + 1
        if level.isEmpty():
            break
        found = found.union(level.select(*DOC, "j", "r", F.lit(k)))
    return first, found


def _windows(first: DataFrame, min_words: int) -> DataFrame:
    """(document, j, n): shortest runs of repeated lines with enough words, per first and per last line.

    Every line of a longer run with an earlier copy is in such a run with an earlier copy: in
    the one that begins with it, or in the one that ends with the long run.
    """
    island = F.col("j") - F.row_number().over(W.partitionBy(*DOC).orderBy("j"))
    rows = first.select(*DOC, "j", "words").withColumn("g", island)
    part = [*DOC, "g"]
    rows = rows.withColumn("c", F.sum("words").over(W.partitionBy(*part).orderBy("j").rowsBetween(W.unboundedPreceding, 0)))
    before = F.col("c") - F.col("words")
    points = F.array(
        # ends at c; the run that begins with a line ends with the first end at before + min_words or later
        F.struct(F.lit(0).alias("side"), F.col("c").alias("at"), F.lit(1).alias("ask")),
        F.struct(F.lit(0).alias("side"), (before + min_words).alias("at"), F.lit(0).alias("ask")),
        # starts at before; the run that ends with a line begins with the last start at c - min_words or earlier
        F.struct(F.lit(1).alias("side"), (-before).alias("at"), F.lit(1).alias("ask")),
        F.struct(F.lit(1).alias("side"), (-(F.col("c") - min_words)).alias("at"), F.lit(0).alias("ask")),
    )
    rows = rows.select(*part, "j", F.explode(points).alias("p")).select(*part, "j", "p.side", "p.at", "p.ask")
    # from the far end: questions come behind the answers at their place
    far = W.partitionBy(*part, "side").orderBy(F.col("at").desc(), F.col("ask").desc()).rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("other", F.last(F.when(F.col("ask") == 1, F.col("j")), ignorenulls=True).over(far)).where("ask = 0 and other is not null")
    start, end = F.least("j", "other"), F.greatest("j", "other")
    return rows.select(*DOC, start.alias("j"), (end - start + 1).alias("n")).distinct()


def deleted_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(_doc, _text, lines): numbers of the lines to delete, per document that has any.

    Every run of lines with at least ``min_words`` words in all that has a copy at an earlier
    place (document id, text hash, line) is deleted. Lines without a word count as absent.
    """
    lines = durable(_lines(docs))  # texts are split once
    first, ranks = _ranks(lines, min_words)  # a run has a word per line at least
    windows = _windows(first, min_words).withColumn("k", F.floor(F.log2("n")).cast("int"))
    windows = windows.withColumn("z", F.expr("j + n - cast(shiftleft(1, k) as int)"))
    head = ranks.withColumnRenamed("r", "ra")
    tail = ranks.withColumnRenamed("r", "rb").withColumnRenamed("j", "z")
    keys = ["n", "ra", "rb"]
    # null ids are matched through a key of their own
    runs = durable(_joined(_joined(windows, head, ["j", "k"]), tail, ["z", "k"]).select(*DOC, "j", *keys))
    at = F.struct(*DOC, "j")
    intervals = runs.groupBy(*keys).agg(F.min(at).alias("lo"), F.max(at).alias("hi")).where("lo < hi").select(*keys, "lo")
    later = runs.join(intervals, keys).where(at > F.col("lo"))
    gone = later.select(*DOC, F.explode(F.sequence("j", F.col("j") + F.col("n") - 1)).alias("j")).distinct()
    numbered = _joined(gone, first.select(*DOC, "j", "line").distinct(), ["j"])
    return numbered.groupBy(*DOC).agg(F.collect_set("line").alias("lines"))  # at most the document's lines


def _joined(left: DataFrame, right: DataFrame, also: list[str], how: str = "inner") -> DataFrame:
    """Join on the document (null ids equal) and the columns ``also``."""
    named = right.withColumnsRenamed({"_doc": "_r_doc", "_text": "_r_text", **{c: f"_r_{c}" for c in also}})
    same = F.col("_doc").eqNullSafe(F.col("_r_doc")) & (F.col("_text") == F.col("_r_text"))
    for c in also:
        same &= F.col(c) == F.col(f"_r_{c}")
    return left.join(named, same, how).drop("_r_doc", "_r_text", *[f"_r_{c}" for c in also])


def _with_lines(docs: DataFrame, min_words: int) -> DataFrame:
    gone = durable(deleted_lines(docs, min_words))
    # the list of documents to change grows with the table: the same join at every size
    return _joined(_keyed(docs), gone.withColumnRenamed("lines", "_lines").hint("merge"), [], "left").drop(*DOC)


def _kept_text() -> Column:
    numbers = F.array_except(F.sequence(F.lit(0), F.size(F.split("text", "\n")) - 1), "_lines")
    kept = F.array_join(F.transform(F.array(F.split("text", "\n")), lambda ls: F.array_join(F.transform(numbers, lambda i: F.get(ls, i)), "\n")), "")
    return F.when(F.col("_lines").isNull(), F.col("text")).otherwise(kept)


def report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per document: doc_id, n_lines, n_deleted, kept_sha256, kept (false if no word is left of some).

    A null text has no lines and is kept; its digest is that of the empty text. Rows alike in
    id and text get the same answer. Extra columns are ignored.
    """
    rows = _with_lines(docs.select("doc_id", F.col("text").cast("string").alias("text")), min_words).withColumn("rest", _kept_text())
    n = F.coalesce(F.size(F.split("text", "\n")), F.lit(0))
    return rows.select(
        "doc_id", F.when(F.col("text").isNull(), 0).otherwise(n).cast("bigint").alias("n_lines"),
        F.when(F.col("_lines").isNull(), 0).otherwise(F.size("_lines")).cast("bigint").alias("n_deleted"),
        F.sha2(F.coalesce("rest", F.lit("")), 256).alias("kept_sha256"),
        (F.col("_lines").isNull() | F.coalesce(F.col("rest").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))).alias("kept"),
    )


def deduplicate(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the deleted lines; documents of which no word is left are dropped."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")  # its names cannot clash with those in use here
    rows = _with_lines(docs.select("doc_id", "text", whole), min_words).withColumn("_rest", _kept_text())
    left = rows.where(F.col("_lines").isNull() | F.col("_rest").rlike(r"[^\x20\x09-\x0D]"))
    return left.select(F.col("_row").withField("text", F.col("_rest")).alias("_row")).select("_row.*")
