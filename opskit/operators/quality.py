"""Reconciliation and data quality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from opskit.functions import units
from opskit.operators.aggregates import prevalence
from opskit.operators.joins import compare_sides, not_in, resolve_polymorphic
from opskit.operators.ordered import null_safe_join
from opskit.operators.reshape import bucket_counts, signature, unpivot
from opskit.session import durable


def reconcile_counts(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Row count per key on both sides and the difference."""
    count = lambda d: d.groupBy(key).agg(F.count("*").alias("n"))
    return compare_sides(count(a), count(b), [key], ["n"])


def orphans(disk: DataFrame, registered: DataFrame, key: str) -> DataFrame:
    """Keys known to one side only."""
    only = lambda x, y, label: x.select(key).join(y.select(key), key, "left_anti").distinct().withColumn("side", F.lit(label))
    return only(disk, registered, "disk only").unionByName(only(registered, disk, "registered only"))


def missing_names(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    return a.select(col).distinct().join(b.select(col), col, "left_anti")


def orphan_refs(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Number of child rows whose reference is absent (NULL references are not counted)."""
    return not_in(child.select(col), col, parent.select(parent_col), parent_col).agg(F.count("*").alias("orphans"))


def completeness(
    df: DataFrame, key: str, required: Sequence[str], children: DataFrame, child_key: str, mapping: DataFrame | None = None, listed: DataFrame | None = None
) -> DataFrame:
    """One row per issue and entity: a missing attribute, no child rows, no row in ``mapping``
    (by ``key``), or named in ``listed`` (by ``key``) but absent."""
    issues = F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in required]), lambda x: x.isNotNull())
    attrs = df.select(key, F.explode(issues).alias("issue"))
    kids = children.select(F.col(child_key).alias(key)).distinct()
    lonely = df.select(key).join(kids, key, "left_anti").withColumn("issue", F.lit("no child rows"))
    out = attrs.unionByName(lonely)
    if mapping is not None:
        out = out.unionByName(df.select(key).join(mapping.select(key).distinct(), key, "left_anti").withColumn("issue", F.lit("no mapping")))
    if listed is not None:
        out = out.unionByName(listed.select(key).distinct().join(df.select(key), key, "left_anti").withColumn("issue", F.lit("listed but absent")))
    return out


def oversize_columns(df: DataFrame, declared: Mapping[str, int]) -> DataFrame:
    """Declared against longest actual length per text column, in one pass."""
    longest = df.agg(*[F.coalesce(F.max(F.length(c)), F.lit(0)).alias(c) for c in declared])
    rows = unpivot(longest, [], list(declared), "column_name", "max_length")
    size = reduce(lambda acc, kv: acc.when(F.col("column_name") == kv[0], kv[1]), declared.items(), F.when(F.lit(False), 0))
    return rows.withColumn("declared", size).withColumn("unused", F.col("declared") - F.col("max_length"))


def type_mismatches(columns: DataFrame, name: str = "column_name", definition: Sequence[str] = ("data_type",)) -> DataFrame:
    """Every definition of column names that are declared in more than one way, with the
    share of the definition among all columns of that name."""
    counts = columns.groupBy(name, *definition).agg(F.count("*").alias("tables"))
    per = counts.groupBy(name).agg(F.count("*").alias("definitions"), F.sum("tables").alias("_all"))
    return counts.join(per, name).filter("definitions > 1").withColumn(
        "prevalence", F.col("tables") * 100.0 / F.col("_all")).drop("_all")


def duplicate_definitions(items: DataFrame, obj: str, name: str, item: str, position: str) -> DataFrame:
    """Definitions with the same ordered item list on the same object.

    Each one is reported with the first definition it repeats, so a group of copies gives
    one row per copy instead of all pairs.
    """
    sig = durable(signature(items, [obj, name], item, position))
    groups = sig.groupBy(obj, "signature").agg(F.min(name).alias("same_as"), F.count("*").alias("copies")).filter("copies > 1")
    return null_safe_join(sig, groups, [obj, "signature"]).filter(F.col(name) != F.col("same_as"))


def count_by_kind(df: DataFrame, key: str, kind: str, kinds: Sequence[str]) -> DataFrame:
    return bucket_counts(df, key, kind, kinds)


def lacking(df: DataFrame, key: str, holders: DataFrame, holder_key: str) -> DataFrame:
    """Entities without a property."""
    return df.select(key).join(holders.select(F.col(holder_key).alias(key)), key, "left_anti")


def table_sizes(tables: DataFrame, parts: DataFrame, key: str, rows: str, pages: str) -> DataFrame:
    """Rows and size (8 KB pages) per table, 0 when it has no parts."""
    agg = parts.groupBy(key).agg(F.sum(rows).alias("row_count"), F.sum(pages).alias("pages"))
    d = tables.join(agg, key, "left").fillna(0, ["row_count", "pages"])
    return d.withColumn("size", units.fmt_size(F.col("pages") * 8192))


def permissions(grants: DataFrame, dims: Mapping[object, tuple[DataFrame, str, str]]) -> DataFrame:
    """Grants with the name of the object they refer to and the statement text."""
    named = resolve_polymorphic(grants, "class", "object_id", dims)
    return named.withColumn(
        "grant_text",
        F.concat(F.col("state"), F.lit(" "), F.col("permission"), F.lit(" ON ["), F.col("object_name"), F.lit("] TO ["), F.col("grantee"), F.lit("]")))
