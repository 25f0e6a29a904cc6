"""Space, growth, backups and maintenance candidates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from opskit.functions import clock, text, units
from opskit.operators.filters import BACKUP_TYPES, at_latest, decode
from opskit.operators.joins import longest_prefix_join
from opskit.operators.ordered import first_per_key, global_row_number, latest_per_key


def maintenance_candidates(df: DataFrame, min_pages: int = 1000, fragmentation: float = 30) -> DataFrame:
    """Large fragmented indexes, or ones modified at least sqrt(rows * 1000) times."""
    worn = (F.col("pages") >= min_pages) & (F.col("fragmentation") >= fragmentation)
    old = (F.col("modified") > 0) & (F.col("modified") >= F.sqrt(F.col("row_count") * 1000))
    return df.filter(worn | old)


def capacity(files: DataFrame, volumes: DataFrame) -> DataFrame:
    """Size, use and free space per volume, database and file type with the volume's share."""
    placed = longest_prefix_join(files, "file_id", "path", volumes, "volume", ["capacity_mb"], "/")
    sums = placed.groupBy("volume", "db_name", "type_desc").agg(
        F.max("capacity_mb").alias("capacity_mb"), F.count("*").alias("files"), F.sum("size_mb").alias("size_mb"), F.sum("used_mb").alias("used_mb"))
    return sums.withColumns({
        "free_mb": F.col("size_mb") - F.col("used_mb"),
        "size_gb": units.scale_units("size_mb", "MB", "GB"),
        "used_percent": F.try_divide(F.col("used_mb") * 100.0, F.col("size_mb")),
        "volume_percent": F.try_divide(F.col("size_mb") * 100.0, F.col("capacity_mb")),
    })


def growth(df: DataFrame, ts: str, now, hours: int = 2, keys: Sequence[str] = ("db_name",)) -> DataFrame:
    """Growth of data and log use inside the look-back (largest minus smallest)."""
    d = df.filter((F.col(ts) >= now - F.make_dt_interval(hours=F.lit(hours))) & (F.col(ts) <= now))

    def span(kind: str) -> Column:
        used = F.when(F.col("type_desc") == kind, F.col("used_mb"))
        return F.coalesce(F.max(used) - F.min(used), F.lit(0))

    return d.groupBy(*keys).agg(span("ROWS").alias("data_growth"), span("LOG").alias("log_growth"))


def space_alerts(df: DataFrame, keys: Sequence[str], threshold: float, store: str = "LOG", share: float = 0.3) -> DataFrame:
    """Use of the secondary store beyond its threshold or beyond a share of the data in use."""
    used = lambda k: F.sum(F.when(F.col("type_desc") == k, F.col("used_mb")).otherwise(0))
    d = df.groupBy(*keys).agg(used("ROWS").alias("data_mb"), used(store).alias("store_mb"))
    return d.filter((F.col("store_mb") >= threshold) | (F.col("store_mb") >= F.col("data_mb") * share))


def space_to_add(total: Column, used: Column, percent_free: float) -> Column:
    """Space to add so that ``percent_free`` of the new total is free."""
    return F.greatest(used / (1 - percent_free / 100.0) - total, F.lit(0.0))


def space_requirement(df: DataFrame, key: str, size: str, percent_free: float = 35, scratch: str = "scratch", scratch_share: float = 0.2) -> DataFrame:
    """Total size per database with the space to add, and the scratch rule (20 % of everything)."""
    per = df.groupBy(key).agg(F.sum(size).alias("size"))
    tmp = per.agg((F.sum("size") * scratch_share).alias("size")).select(F.lit(scratch).alias(key), "size")
    both = per.select(key, F.col("size").cast("double").alias("size")).unionByName(tmp.select(key, F.col("size").cast("double").alias("size")))
    return both.withColumn("to_add", space_to_add(F.col("size"), F.col("size"), percent_free))


def estimate_total(history: DataFrame, entities: DataFrame, key: str, size: str) -> DataFrame:
    """Sum over all entities of their largest recorded size."""
    top = history.groupBy(key).agg(F.max(size).alias("top"))
    j = entities.select(key).distinct().join(top, key, "left")
    return j.agg(F.count("*").alias("entities"), F.count("top").alias("known"), F.sum("top").alias("total"))


def freshness(df: DataFrame, batch: str, last: str, now) -> DataFrame:
    """Yes/No flags for a full backup in the last 24 hours and 7 days, on the latest batch."""
    flag = lambda unit, n: F.when(F.col(last).isNull() | (clock.datediff_boundary(unit, last, now) >= n), "No").otherwise("Yes")
    return at_latest(df, batch).withColumns({"full_backup_24h": flag("hour", 24), "full_backup_7d": flag("day", 7)})


def latest_full(history: DataFrame, key: str, ts: str, size: str, tie: str) -> DataFrame:
    """Latest full backup of each database, numbered by falling size."""
    last = latest_per_key(history.filter("type = 'D'"), [key], ts, [tie])
    return global_row_number(last, [F.col(size).desc(), F.col(key).asc()], "size_rank")


def next_in_chain(files: DataFrame, applied: DataFrame, key: str = "db_name") -> DataFrame:
    """Log files still to apply per database, in order.

    ``applied`` has the last applied file, its start and an optional newer full restore
    time; a full restore at or after the last log voids the starting point.
    """
    j = files.join(applied, key, "left")
    voided = F.col("last_full") >= F.col("last_log")
    anchor = F.when(~F.coalesce(voided, F.lit(False)), F.col("last_file"))
    todo = j.withColumn("_anchor", anchor).filter(
        F.col("_anchor").isNull() | ((F.col("start_time") >= F.col("last_start")) & (F.col("file_name") != F.col("_anchor"))))
    return todo.drop("_anchor")


def buffer_usage(pages: DataFrame, key: str, free_bytes: str) -> DataFrame:
    """Buffer use per database in whole MB of 8 KB pages, empty MB and percent."""
    d = pages.groupBy(key).agg(F.count("*").alias("pages"), F.sum(free_bytes).alias("free_bytes"))
    return d.withColumns({
        "used_mb": F.floor(F.col("pages") * 8 / 1024).cast("bigint"),
        "empty_mb": F.floor(F.col("free_bytes") / 1048576).cast("bigint"),
        "empty_percent": F.try_divide(F.col("free_bytes") * 100.0, F.col("pages") * 8192),
    })


def weighted_score(df: DataFrame, seeks: str, cost: str, impact: str) -> DataFrame:
    """Seeks times cost times impact percent."""
    return df.withColumn("advantage", (F.col(seeks) * F.col(cost) * (F.col(impact) * 0.01)).cast("decimal(18,2)"))


def latest_paths(history: DataFrame, entity: str, kind: str, ts: str, path: str, tie: str) -> DataFrame:
    """One representative per (type, folder, extension) among each entity's latest files."""
    last = first_per_key(history, [entity, kind], [F.col(ts).desc(), F.col(tie).desc()])
    d = last.withColumns({"backup_type": decode(kind, BACKUP_TYPES), "folder": text.dirname(path, "/"), "extension": F.right(F.col(path), F.lit(3))})
    return first_per_key(d, ["backup_type", "folder", "extension"], [entity, tie])
