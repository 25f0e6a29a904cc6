"""Aggregations, shares, top-k and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from opskit.operators.ordered import global_rank, null_safe_join


def sum_if(cond: Column, value=1) -> Column:
    return F.sum(F.when(cond, value).otherwise(0))


def counts_per_key(base: DataFrame, key: str, facts: DataFrame, fact_key: str, counts: Mapping[str, Column]) -> DataFrame:
    """Several correlated counts per row as one conditional aggregate and a left join."""
    agg = facts.groupBy(F.col(fact_key).alias(key)).agg(*[F.count(F.when(c, 1)).alias(n) for n, c in counts.items()])
    joined = base.join(agg, key, "left")
    return joined.fillna(0, list(counts))


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], cols: Sequence[str], *aggs: Column) -> DataFrame:
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *cols).agg(*aggs)


def collapse_max(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key holding the maximum of every other column."""
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in df.columns if c not in keys])


def weighted_avg(num: str, den: str, precision: int = 22, scale: int = 2) -> Column:
    """sum(num) / sum(den) in fixed decimals."""
    d = f"decimal({precision},{scale})"
    return (F.sum(num).cast(d) / F.sum(den)).cast(d)


def share(df: DataFrame, value: str, out: str = "percentage", by: Sequence[str] = ()) -> DataFrame:
    """100 * value / total; the total is a one-value subquery or a joined aggregate."""
    if not by:
        return df.withColumn(out, F.try_divide(F.col(value) * 100.0, df.agg(F.sum(value)).scalar()))
    total = df.groupBy(*by).agg(F.sum(value).alias("_total"))
    return null_safe_join(df, total, list(by), "left").withColumn(
        out, F.try_divide(F.col(value) * 100.0, F.col("_total"))
    ).drop("_total")


def string_agg(col: str | Column, sep: str, order: Column | None = None, distinct: bool = False) -> Column:
    """Ordered concatenation; for groups of bounded size (see ``nest`` for others)."""
    c = F.col(col) if isinstance(col, str) else col
    if distinct:
        return F.array_join(F.array_sort(F.collect_set(c)), sep)
    key = c if order is None else order
    items = F.sort_array(F.collect_list(F.struct(key.alias("k"), c.alias("v"))))
    return F.array_join(F.transform(items, lambda x: x["v"].cast("string")), sep)


def row_winner(df: DataFrame, cols: Sequence[str], value_out: str = "best", name_out: str = "winner") -> DataFrame:
    """Smallest value across columns and the name of the (first) column that holds it."""
    entries = F.array(*[F.struct(F.col(c).cast("double").alias("v"), F.lit(i).alias("i"), F.lit(c).alias("n")) for i, c in enumerate(cols)])
    best = F.array_min(F.filter(entries, lambda e: e["v"].isNotNull()))
    return df.withColumn("_best", best).withColumn(value_out, F.col("_best.v")).withColumn(name_out, F.col("_best.n")).drop("_best")


def argmax(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the largest ``order`` per key (partial aggregation, no window)."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def latest_value(df: DataFrame, ts: str, value: str, keys: Sequence[str] = (), tie: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(ts).alias(ts), F.max_by(value, F.struct(ts, *tie)).alias(value))


def prevalence(df: DataFrame, key: str) -> DataFrame:
    """Row count per key and its percentage of all rows."""
    return share(df.groupBy(key).agg(F.count("*").alias("n")), "n")


def top_k(df: DataFrame, order: Sequence[Column], k: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(*order, *tiebreak).limit(k)


def top_k_ties(df: DataFrame, cols: Sequence[str], k: int, desc: bool = True) -> DataFrame:
    """Top-k with ties: every row not worse than the k-th one."""
    order = [F.col(c).desc() if desc else F.col(c).asc() for c in cols]
    edge = df.orderBy(*order).limit(k).select(F.struct(*cols).alias("_e"))
    bound = edge.agg(F.min("_e") if desc else F.max("_e")).scalar()
    here = F.struct(*cols)
    return df.withColumn("_edge", bound).filter(here >= F.col("_edge") if desc else here <= F.col("_edge")).drop("_edge")


def page(df: DataFrame, order: Sequence[Column], offset: int, n: int) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(n)


def order_by_name(df: DataFrame, name: str, allowed: Sequence[str], k: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    if name not in allowed:
        raise ValueError(f"sort column must be one of {list(allowed)}")
    return df.orderBy(F.col(name).desc(), *tiebreak).limit(k)


def rank_groups(df: DataFrame, cols: Sequence[str], out: str = "rank", desc: bool = False) -> DataFrame:
    return global_rank(df, cols, out, desc)


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def union_sources(named: Mapping[str, DataFrame], label: str = "source_name") -> DataFrame:
    """Same-shaped tables of several instances as one, with the instance name."""
    return union_all(*[df.withColumn(label, F.lit(name)) for name, df in named.items()])


def union_tiers(ts: str, tiers: Sequence[tuple[DataFrame, object, object]]) -> DataFrame:
    """Raw and rolled-up tiers as one series without overlap: (df, from, to), from <= ts < to."""
    cut = []
    for df, start, end in tiers:
        if start is not None:
            df = df.filter(F.col(ts) >= start)
        if end is not None:
            df = df.filter(F.col(ts) < end)
        cut.append(df)
    return union_all(*cut)
