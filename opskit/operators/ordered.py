"""Order-dependent building blocks that stay whole and balanced when one key is hot.

Two techniques are used instead of one large window:

* a *global* order is computed on a range-partitioned copy: every task numbers its own
  range, and the per-range totals (one row per partition) give the offsets;
* a *series* order (lag, fill-forward, running sum inside a key) is cut into slices of
  about equally many rows by (key, time, tie).  Each slice starts with one seed row that
  carries the state of the key's earlier slices, so a key with a third of all rows is
  spread over a third of all slices, also if these rows have one time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from opskit.session import durable

_LOW33 = (1 << 33) - 1


def _cols(order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


# -- global order -----------------------------------------------------------------------


def placed(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Range-partitioned, sorted and durable copy with ``_part`` and ``_pos`` (0-based)."""
    order = _cols(order)
    mid = F.monotonically_increasing_id()
    numbered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", mid)
        .withColumn("_part", F.shiftright("_mid", 33))
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_LOW33)))
        .drop("_mid")
    )
    return durable(numbered)


def _edge_rows(p: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of ``placed`` whose key begins or ends its range.

    The rows are sorted by key first, so only such keys can lie in several ranges; there are at
    most two of them a range, however many keys there are.
    """
    key = F.struct(*by)
    ends = p.groupBy("_part").agg(F.min_by(key, "_pos").alias("_first"), F.max_by(key, "_pos").alias("_last"))
    rows = p.join(F.broadcast(ends), "_part")  # one row per partition
    return rows.filter(key.eqNullSafe(F.col("_first")) | key.eqNullSafe(F.col("_last"))).drop("_first", "_last")


def _offsets(parts: DataFrame, total: str) -> DataFrame:
    """Exclusive prefix sums over one row per partition."""
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    return parts.select("_part", F.coalesce(F.sum(total).over(before), F.lit(0)).alias("_before"))


def global_row_number(df: DataFrame, order, out: str = "row_num") -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY ...) without moving all rows into one task."""
    p = placed(df, order)
    offsets = _offsets(p.groupBy("_part").agg(F.count("*").alias("_n")), "_n")
    return (
        p.join(F.broadcast(offsets), "_part")  # one row per partition
        .withColumn(out, F.col("_before") + F.col("_pos") + 1)
        .drop("_part", "_pos", "_before")
    )


def global_running_sum(df: DataFrame, value: str, order, out: str = "running") -> DataFrame:
    """Inclusive running sum over a global order (a prefix sum over balanced ranges)."""
    p = placed(df, order)
    offsets = _offsets(p.groupBy("_part").agg(F.sum(value).alias("_n")), "_n")
    inside = W.partitionBy("_part").orderBy("_pos").rowsBetween(W.unboundedPreceding, 0)
    return (
        p.withColumn("_inside", F.sum(value).over(inside))
        .join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_before") + F.col("_inside"))
        .drop("_part", "_pos", "_before", "_inside")
    )


def global_dense_rank(df: DataFrame, cols: Sequence[str], out: str = "rank", desc: bool = False) -> DataFrame:
    """DENSE_RANK over whole columns: number the distinct values, then join them back."""
    order = [F.col(c).desc() if desc else F.col(c).asc() for c in cols]
    ranks = global_row_number(df.select(*cols).distinct(), order, out)
    return null_safe_join(df, ranks, list(cols), "left")


def global_rank(df: DataFrame, cols: Sequence[str], out: str = "rank", desc: bool = False) -> DataFrame:
    """RANK: one more than the number of rows in front of the tie group."""
    order = [F.col(c).desc() if desc else F.col(c).asc() for c in cols]
    sizes = df.groupBy(*cols).agg(F.count("*").alias("_size"))
    ranks = global_running_sum(sizes, "_size", order, "_run").select(
        *cols, (F.col("_run") - F.col("_size") + 1).alias(out)
    )
    return null_safe_join(df, ranks, list(cols), "left")


def row_number_in(df: DataFrame, by: Sequence[str], order, out: str = "row_num") -> DataFrame:
    """ROW_NUMBER inside groups that may be very large."""
    return running_sum_in(df.withColumn("_one", F.lit(1).cast("bigint")), by, "_one", order, out).drop("_one")


def running_sum_in(df: DataFrame, by: Sequence[str], value: str, order, out: str = "running") -> DataFrame:
    """Running sum inside groups that may be very large.

    Rows are summed inside (group, range) and shifted by the sum of the group's earlier
    ranges, so no value of another group enters.
    """
    if not by:
        return global_running_sum(df, value, order, out)
    p = placed(df, [*by, *order])
    totals = _edge_rows(p, by).groupBy(*by, "_part").agg(F.sum(value).alias("_n"))
    before = W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(*by, "_part", F.sum("_n").over(before).alias("_before")).filter("_before is not null")
    inside = W.partitionBy(*by, "_part").orderBy("_pos").rowsBetween(W.unboundedPreceding, 0)
    # at most one key a range goes on from an earlier one
    rows = null_safe_join(p.withColumn("_inside", F.sum(value).over(inside)), F.broadcast(offsets), [*by, "_part"], "left")
    total = F.when(F.col("_before").isNull(), F.col("_inside")).otherwise(F.col("_before") + F.coalesce("_inside", F.lit(0)))
    return rows.withColumn(out, total).drop("_part", "_pos", "_before", "_inside")


def ntile_in(df: DataFrame, n: int, by: Sequence[str], order, out: str = "tile", rank_out: str | None = None) -> DataFrame:
    """NTILE(n) from row number and group size: the first ``size % n`` tiles get one more.

    ``rank_out`` also keeps the row number.
    """
    ranked = row_number_in(df, by, order, "_rn") if by else global_row_number(df, order, "_rn")
    if by:
        ranked = with_group(ranked, by, _n=F.count("*"))
    else:
        ranked = ranked.withColumn("_n", ranked.agg(F.count("*")).scalar())
    small, extra = F.expr(f"_n div {n}"), F.expr(f"_n % {n}")
    big_rows = extra * (small + 1)
    tile = F.when(
        F.col("_rn") <= big_rows, F.expr(f"(_rn - 1) div (_n div {n} + 1)") + 1
    ).otherwise(
        extra + F.expr(f"(_rn - 1 - (_n % {n}) * (_n div {n} + 1)) div greatest(_n div {n}, 1)") + 1
    )
    ranked = ranked.withColumn(out, tile).drop("_n")
    return ranked.drop("_rn") if rank_out is None else ranked.withColumnRenamed("_rn", rank_out)


# -- keyed joins ------------------------------------------------------------------------


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join on keys where NULL equals NULL; the right keys are dropped."""
    if not keys:
        raise ValueError("a join without keys would pair all rows")
    marked = right
    cond = None
    for i, k in enumerate(keys):
        marked = marked.withColumnRenamed(k, f"_r{i}")
        c = left[k].eqNullSafe(F.col(f"_r{i}"))
        cond = c if cond is None else cond & c
    joined = left.join(marked, cond, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r{i}" for i in range(len(keys))])


def first_per_key(df: DataFrame, keys: Sequence[str], order) -> DataFrame:
    """Keep the first row per key.

    The filter on the row number lets Spark cut every map-side group to one row before
    the shuffle (WindowGroupLimit), so a hot key sends one row per task.
    """
    w = W.partitionBy(*keys).orderBy(*_cols(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def top_per_key(df: DataFrame, keys: Sequence[str], order, k: int, out: str = "rank") -> DataFrame:
    """First ``k`` rows per key, cut map-side in the same way."""
    w = W.partitionBy(*keys).orderBy(*_cols(order))
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= k)


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str] = ()) -> DataFrame:
    return first_per_key(df, keys, [F.col(ts).desc(), *[F.col(c).desc() for c in tie]])


def with_group(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Aggregate OVER (PARTITION BY keys), as a map-side combined aggregate joined back."""
    per_key = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return null_safe_join(df, per_key, list(keys), "left")


# -- series order -----------------------------------------------------------------------

# A series is ordered by time and tie inside its key. The rows are range partitioned on (key,
# time, tie), always and at every size: a range is a slice, a hot key or a single hot instant
# lies in as many slices as its rows need, and small keys share one. Every slice of a key but
# its first starts with one seed row that carries the state of the slices before.


def _series(df: DataFrame, keys: Sequence[str], order: Sequence[str], carry) -> tuple[DataFrame, list[str], list[str]]:
    """Rows ready for a window inside their slice: (rows, partition columns, leading order).

    A key that goes on from another slice gets one seed row there (``_seed`` 0) whose ``_pay`` is
    the state that ``carry`` computes from the key's other slices.
    """
    p = placed(df, [*keys, *order])
    d, edges = (x.drop("_pos").withColumnRenamed("_part", "_slice") for x in (p, _edge_rows(p, keys)))
    seeds = carry(edges).select(*keys, "_slice", F.col("_carry").alias("_pay"), F.lit(0).alias("_seed")).filter("_pay is not null")
    return d.withColumn("_seed", F.lit(1)).unionByName(seeds, allowMissingColumns=True), [*keys, "_slice"], ["_seed"]


def series_lag(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], prefix: str = "prev_", lead: bool = False
) -> DataFrame:
    """LAG (or LEAD) of several columns inside a series; ``order`` is the time and a tie-break."""
    sort = (lambda c: F.col(c).desc()) if lead else (lambda c: F.col(c).asc())
    pick = F.min_by if lead else F.max_by

    def carry(d: DataFrame) -> DataFrame:
        edge = d.groupBy(*keys, "_slice").agg(pick("_pay", F.struct(*order)).alias("_edge"))
        return edge.withColumn("_carry", F.lag("_edge").over(W.partitionBy(*keys).orderBy(sort("_slice"))))

    rows, part, head = _series(df.withColumn("_pay", F.struct(*cols)), keys, order, carry)
    w = W.partitionBy(*part).orderBy(*head, *[sort(c) for c in order])
    out = rows.withColumn("_prev", F.lag("_pay").over(w)).filter("_seed = 1")
    for c in cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_prev.{c}"))
    return out.drop("_seed", "_slice", "_pay", "_prev")


def series_running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str | Column, out: str) -> DataFrame:
    """Inclusive running sum inside a series."""

    def carry(d: DataFrame) -> DataFrame:
        total = d.groupBy(*keys, "_slice").agg(F.sum("_pay").alias("_total"))
        before = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
        return total.withColumn("_carry", F.sum("_total").over(before))

    pay = F.col(value) if isinstance(value, str) else value
    rows, part, head = _series(df.withColumn("_pay", pay), keys, order, carry)
    w = W.partitionBy(*part).orderBy(*head, *order).rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn(out, F.sum("_pay").over(w)).filter("_seed = 1").drop("_seed", "_slice", "_pay")


def series_fill(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], payload: str, out: str, backward: bool = True
) -> DataFrame:
    """Nearest earlier (``backward``) or later non-null ``payload``, the row itself included."""
    sort = (lambda c: F.col(c).asc()) if backward else (lambda c: F.col(c).desc())
    pick = F.max_by if backward else F.min_by

    def carry(d: DataFrame) -> DataFrame:
        known = F.when(F.col("_pay").isNotNull(), F.struct(*order))
        edge = d.groupBy(*keys, "_slice").agg(pick("_pay", known).alias("_edge"))
        before = W.partitionBy(*keys).orderBy(sort("_slice")).rowsBetween(W.unboundedPreceding, -1)
        return edge.withColumn("_carry", F.last("_edge", ignorenulls=True).over(before))

    rows, part, head = _series(df.withColumn("_pay", F.col(payload)), keys, order, carry)
    w = W.partitionBy(*part).orderBy(*head, *[sort(c) for c in order]).rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn(out, F.last("_pay", ignorenulls=True).over(w)).filter("_seed = 1").drop("_seed", "_slice", "_pay")
