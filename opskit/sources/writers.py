"""Sinks and table maintenance over plain Parquet folders.

Tables are partitioned by ``date`` where time matters.  A table that is rebuilt from
itself is first written to the checkpoint folder, so a lost executor or a failed write
never leaves the job without its input.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from opskit.functions import clock, text
from opskit.operators.ordered import first_per_key, null_safe_join
from opskit.operators.reshape import document_lines
from opskit.session import durable


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no table yet, or none with files
            return None
        raise


def append_samples(df: DataFrame, path: str, collected_at) -> None:
    """Append a batch stamped with one collection time, partitioned by day."""
    stamped = df.withColumn("collection_time", collected_at).withColumn("date", F.to_date(collected_at))
    stamped.write.mode("append").partitionBy("date").parquet(path)


def append_new(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Append only rows whose keys are not in the table yet; safe to repeat."""
    old = _existing(df.sparkSession, path)
    fresh = df.dropDuplicates(list(keys))
    if old is not None:
        fresh = null_safe_join(fresh, old.select(*keys), keys, "left_anti")
    fresh.write.mode("append").parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Overwrite a table, also with a result computed from that same table."""
    durable(df).write.mode("overwrite").parquet(path)


def overwrite_latest(df: DataFrame, path: str, keys: Sequence[str], order) -> None:
    """Truncate and load one row per key (the first in ``order``)."""
    replace_table(first_per_key(df, keys, order), path)


def _hadoop(spark: SparkSession, path: str, uri: bool = False):
    """(file system, path object) of a path, or of a URI as Spark names its files."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path) if uri else path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _exists(spark: SparkSession, path: str) -> bool:
    fs, at = _hadoop(spark, path)
    return fs.exists(at)


def _delete(spark: SparkSession, path: str, uri: bool = False) -> None:
    fs, at = _hadoop(spark, path, uri)
    fs.delete(at, True)


def _mark(spark: SparkSession, path: str) -> None:
    fs, at = _hadoop(spark, path)
    fs.create(at, True).close()


def _staged(spark: SparkSession, staging: str, files: Sequence[str] | None = None) -> DataFrame:
    return spark.read.option("basePath", staging).parquet(*(files if files is not None else [staging]))


def archive_steps(spark: SparkSession, staging: str, history: str) -> Iterator[str]:
    """The steps of ``archive_and_clear``, each done when its name comes out.

    A move is a folder below ``history/_moves`` with a manifest of the files it takes. It has
    three states: without the mark ``listed`` it never began, with it the files are (again)
    copied as one batch, and from the mark ``copied`` on only the listed files are deleted.
    """
    moves = f"{history}/_moves"
    fs, at = _hadoop(spark, moves)
    open_moves = sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []
    for name in [*open_moves, uuid.uuid4().hex]:
        move, manifest = f"{moves}/{name}", f"{moves}/{name}/files"
        if not _exists(spark, f"{move}/listed"):
            if name in open_moves:
                _delete(spark, move)
                yield "dropped"
                continue
            if _existing(spark, staging) is None:
                return
            full = _staged(spark, staging).select(F.col("_metadata.file_path").alias("value")).distinct()  # names of files that have rows
            full.write.mode("overwrite").text(manifest)
            yield "manifest"
            if spark.read.text(manifest).isEmpty():
                _delete(spark, move)
                return
            _mark(spark, f"{move}/listed")
            yield "listed"
        files = sorted(r["value"] for r in spark.read.text(manifest).collect())
        if not _exists(spark, f"{move}/copied"):
            _staged(spark, staging, [_hadoop(spark, f, uri=True)[1].toString() for f in files]).write.mode("overwrite").parquet(f"{history}/batch={name}")
            yield "batch"
            _mark(spark, f"{move}/copied")
            yield "copied"
        place = lambda f: _hadoop(spark, f, uri=True)[1].toUri().getPath()
        left = _existing(spark, staging)
        listed = {place(f) for f in files}
        if left is not None and all(place(f) in listed for f in left.inputFiles()):  # keeps the schema of an empty staging table
            left.limit(0).write.mode("append").parquet(staging)
            yield "schema"
        for file in files:
            _delete(spark, file, uri=True)
            yield "cleared"
        _delete(spark, move)
        yield "closed"


def archive_and_clear(spark: SparkSession, staging: str, history: str) -> None:
    """Move every staging row to history (column ``batch`` tells the move), then empty staging.

    The move can die after any step: the next call first ends open moves by their manifests, so
    every row is archived once. Rows with equal keys are all kept, and files that arrive
    meanwhile stay in staging. One caller at a time.
    """
    for _ in archive_steps(spark, staging, history):
        pass


def merge_full(target: DataFrame, source: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Three-way merge: every row of either side with its new values and ``action``.

    ``delete`` rows are the ones to leave out of the new table.
    """
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in cols]).withColumn("_in_s", F.lit(True))
    t = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys], *cols).withColumn("_in_t", F.lit(True))
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_t_{k}"))
        cond = c if cond is None else cond & c
    j = s.join(t, cond, "full")
    changed = F.lit(False)
    for c in cols:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    action = (
        F.when(F.col("_in_t").isNull(), "insert").when(F.col("_in_s").isNull(), "delete").when(changed, "update").otherwise("keep"))
    return j.withColumn("action", action).select(
        *[F.coalesce(k, f"_t_{k}").alias(k) for k in keys],
        *[F.when(F.col("action") == "delete", F.col(c)).otherwise(F.col(f"_s_{c}")).alias(c) for c in cols], "action")


def upsert_changed(target: DataFrame, source: DataFrame, key: str, cols: Sequence[str], now) -> DataFrame:
    """Overwrite a column only where the source has a value and it differs; stamp those rows."""
    s = source.select(key, *[F.col(c).alias(f"_s_{c}") for c in cols])
    j = target.join(s, key, "left")
    differs = {c: F.col(f"_s_{c}").isNotNull() & ~F.col(f"_s_{c}").eqNullSafe(F.col(c)) for c in cols}
    any_change = F.lit(False)
    for d in differs.values():
        any_change = any_change | d
    j = j.withColumn("updated_at", F.when(any_change, now))
    return j.withColumns({c: F.when(d, F.col(f"_s_{c}")).otherwise(F.col(c)) for c, d in differs.items()}).select(*target.columns, "updated_at")


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str], order) -> DataFrame:
    """Rows to insert: the first per key in the source that the target lacks."""
    first = first_per_key(source, keys, order)
    return null_safe_join(first, target.select(*keys), keys, "left_anti")


def load_batch(target: DataFrame, staging: DataFrame, keys: Sequence[str], ts: str, tie: str) -> DataFrame:
    """New numbered batch: one row per (minute, key), skipping keys seen within two minutes.

    "Seen" means that some target time is less than two crossed minutes before the staged
    one, which the newest target time of the key decides.
    """
    number = target.agg(F.coalesce(F.max("batch_number"), F.lit(0)) + 1).scalar()
    newest = target.groupBy(*keys).agg(F.max(ts).alias("_newest"))
    j = null_safe_join(staging, newest, keys, "left")
    fresh = j.filter(F.col("_newest").isNull() | (clock.datediff_boundary("minute", "_newest", ts) >= 2)).drop("_newest")
    one = first_per_key(fresh.withColumn("_minute", clock.to_smalldatetime(ts)), [*keys, "_minute"], [tie])
    return one.drop("_minute").withColumn("batch_number", number)


def drop_matched(staging: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    return null_safe_join(staging, target.select(*keys), keys, "left_anti")


def purge(spark: SparkSession, path: str, cutoff: str) -> list[str]:
    """Drop the day folders before ``cutoff`` (yyyy-mm-dd); no data file is read or rewritten."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("date=") and name[5:] < cutoff:
            fs.delete(status.getPath(), True)
            gone.append(name[5:])
    return sorted(gone)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def write_xml_events(df: DataFrame, path: str, row_tag: str = "event", root_tag: str = "events") -> None:
    """Rows as elements of well-formed XML files without indentation; ``_``-columns become attributes."""
    df.write.mode("overwrite").format("xml").options(rowTag=row_tag, rootTag=root_tag, attributePrefix="_", indent="").save(path)


def write_documents(df: DataFrame, path: str, parent: Sequence[str], child: Sequence[str], tag: str, item_tag: str) -> None:
    """One nested document per parent, with its children in order, as lines of text files.

    Lines are range partitioned and sorted, so a document with very many children is written by
    several tasks and its lines go on in the next file; files in the order of their names hold the
    documents one after the other.
    """
    order = [*parent, "kind", "sort"]
    document_lines(df, parent, child, tag, item_tag).repartitionByRange(*order).sortWithinPartitions(*order).select("line").write.mode("overwrite").text(path)


def enlarge(header: DataFrame, detail: DataFrame, key: str, detail_key: str, date: str, n: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """``n`` copies of every header with shifted dates and new keys, and their details.

    The new key is a formula of the old key and the copy number, so details follow their
    header without a map table.
    """
    stride = header.agg(F.max(key) + 1).scalar()
    copies = F.explode(F.sequence(F.lit(1), F.lit(n)))
    new_key = lambda c: F.col(c) + F.col("_stride") * F.col("copy")
    days = F.floor(text.pseudo_random(F.concat_ws(":", key, "copy"), seed) * 365).cast("int")
    h = header.withColumn("_stride", stride).withColumn("copy", copies)
    h = h.withColumn(date, F.col(date) + F.make_dt_interval(days=days)).withColumn(key, new_key(key)).drop("_stride")
    d = detail.join(header.select(F.col(key).alias(detail_key)), detail_key, "left_semi")
    d = d.withColumn("_stride", stride).withColumn("copy", copies).withColumn(detail_key, new_key(detail_key)).drop("_stride")
    return h, d


def dummy_rows(spark: SparkSession, n: int, width: int, seed: int) -> DataFrame:
    """``n`` rows with a repeatable filler of ``width`` characters."""
    digest = F.md5(F.concat(F.col("id").cast("string"), F.lit(f"/{seed}")).cast("binary"))
    return spark.range(n).withColumn("filler", F.substring(F.repeat(digest, -(-width // 32)), 1, width))


def reused(df: DataFrame) -> DataFrame:
    """An intermediate that is read more than once: written once to the shared folder."""
    return durable(df)
