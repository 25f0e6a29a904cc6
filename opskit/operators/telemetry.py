"""Counter, wait and file statistics: deltas, rates, ratios and shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from opskit.functions import clock, units
from opskit.operators.aggregates import union_all
from opskit.operators.filters import IGNORABLE_WAITS, exclude_values, one_per_bucket
from opskit.operators.joins import asof_join, broadcast_if_small, normalised_key
from opskit.operators.ordered import null_safe_join, running_sum_in, series_lag, with_group
from opskit.session import durable

# Counter types.
RAW_TYPES = (65792, 65536)
RATE_TYPES = (272696576, 272696320)
AVERAGE_TYPE = 1073874176
FRACTION_TYPE = 537003264
BASE_TYPE = 1073939712


def counter_delta(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    values: Sequence[str],
    tie: Sequence[str] = (),
    on_reset: str = "keep",
    min_gap: int | None = 1,
    max_gap: int | None = 60,
    monotone: Sequence[str] | None = None,
) -> DataFrame:
    """Change of each counter since the previous sample of its series.

    ``on_reset``: ``keep`` leaves negative changes; ``drop`` removes rows where a
    ``monotone`` counter fell; ``restart`` keeps every row, 0 for the first sample and the
    value itself after a fall.  Gaps are in crossed minutes, None for no limit.
    """
    monotone = list(values if monotone is None else monotone)
    d = series_lag(df, keys, [ts, *tie], [ts, *values])
    d = d.withColumn("elapsed_seconds", clock.datediff_boundary("second", f"prev_{ts}", ts))
    first = F.col(f"prev_{ts}").isNull()
    if on_reset == "restart":
        for v in values:
            now, before = F.col(v), F.col(f"prev_{v}")
            d = d.withColumn(f"{v}_delta", F.when(before.isNull(), 0).when(now < before, now).otherwise(now - before))
        return d
    d = d.filter(~first)
    if on_reset == "drop":
        for v in monotone:
            d = d.filter(F.col(v) >= F.col(f"prev_{v}"))
    elif on_reset != "keep":
        raise ValueError(on_reset)
    gap = clock.datediff_boundary("minute", f"prev_{ts}", ts)
    if min_gap is not None:
        d = d.filter(gap >= min_gap)
    if max_gap is not None:
        d = d.filter(gap <= max_gap)
    for v in values:
        d = d.withColumn(f"{v}_delta", F.col(v) - F.col(f"prev_{v}"))
    return d


def per_second(delta: str) -> Column:
    return F.try_divide(F.col(delta) * F.lit(1.0).cast("double"), F.col("elapsed_seconds"))


FILE_MEASURES = [
    "size_mb", "io_stall_read_ms", "num_of_reads", "bytes_read", "io_stall_write_ms", "num_of_writes", "bytes_written",
]


def _file_change(df: DataFrame, change) -> DataFrame:
    return df.withColumns({
        "size_mb_growth": change("size_mb"),
        "read_stall_ms": change("io_stall_read_ms"),
        "reads": change("num_of_reads"),
        "mb_read": change("bytes_read") / 1048576.0,
        "write_stall_ms": change("io_stall_write_ms"),
        "writes": change("num_of_writes"),
        "mb_written": change("bytes_written") / 1048576.0,
    }).withColumns({
        "avg_read_stall_ms": F.when(F.col("reads") == 0, 0).otherwise(units.int_div("read_stall_ms", "reads")),
        "avg_write_stall_ms": F.when(F.col("writes") == 0, 0).otherwise(units.int_div("write_stall_ms", "writes")),
    })


FILE_OUT = ["size_mb_growth", "read_stall_ms", "avg_read_stall_ms", "reads", "mb_read", "write_stall_ms", "avg_write_stall_ms", "writes", "mb_written"]


def file_io_delta(df: DataFrame, keys: Sequence[str], ts: str, min_gap: int | None = 1, max_gap: int | None = 60) -> DataFrame:
    """Per-file change between neighbouring snapshots; resets are dropped."""
    d = counter_delta(df, keys, ts, FILE_MEASURES, on_reset="drop", min_gap=min_gap, max_gap=max_gap, monotone=["num_of_reads", "num_of_writes"])
    return _file_change(d, lambda c: F.col(f"{c}_delta")).select(*keys, ts, "elapsed_seconds", *FILE_OUT)


def file_io_asof(df: DataFrame, ts: str, at, path: str) -> DataFrame:
    """Latency and transfer sizes since start, at one snapshot (integer averages, 0 when idle)."""
    d = df.filter(F.col(ts) == at)
    div = lambda a, n: F.when(F.col(n) == 0, 0).otherwise(units.int_div(a, n))
    d = d.withColumns({
        "_stall": F.col("io_stall_read_ms") + F.col("io_stall_write_ms"),
        "_ops": F.col("num_of_reads") + F.col("num_of_writes"),
        "_bytes": F.col("bytes_read") + F.col("bytes_written"),
    })
    return d.withColumns({
        "drive": F.left(F.col(path), F.lit(2)),
        "read_latency": div("io_stall_read_ms", "num_of_reads"),
        "write_latency": div("io_stall_write_ms", "num_of_writes"),
        "latency": div("_stall", "_ops"),
        "bytes_per_read": div("bytes_read", "num_of_reads"),
        "bytes_per_write": div("bytes_written", "num_of_writes"),
        "bytes_per_transfer": div("_bytes", "_ops"),
    }).drop("_stall", "_ops", "_bytes")


def delta_between(df: DataFrame, keys: Sequence[str], ts: str, start, end) -> DataFrame:
    """File statistics between the first snapshot >= start and the last one <= end."""
    d = df.filter((F.col(ts) >= start) & (F.col(ts) <= end))
    edge = d.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).select(F.struct("lo", "hi")).scalar()
    d = d.withColumn("_edge", edge).withColumn("_lo", F.col("_edge.lo")).withColumn("_hi", F.col("_edge.hi")).filter((F.col(ts) == F.col("_lo")) | (F.col(ts) == F.col("_hi")))
    at = lambda c, t: F.max(F.when(F.col(ts) == F.col(t), F.col(c)))
    both = d.filter("_lo < _hi").groupBy(*keys).agg(
        F.max("_lo").alias("lower_time"), F.max("_hi").alias(ts),
        *[at(c, "_lo").alias(f"{c}_0") for c in FILE_MEASURES], *[at(c, "_hi").alias(f"{c}_1") for c in FILE_MEASURES],
    )
    same = (F.col("num_of_reads_1") >= F.col("num_of_reads_0")) & (F.col("num_of_writes_1") >= F.col("num_of_writes_0"))
    out = _file_change(both.filter(same), lambda c: F.col(f"{c}_1") - F.col(f"{c}_0"))
    return out.withColumn("elapsed_seconds", clock.datediff_boundary("second", "lower_time", ts)).select(*keys, ts, "elapsed_seconds", *FILE_OUT)


def interpret_counters(deltas: DataFrame, series: Sequence[str], ts: str) -> DataFrame:
    """Readable value of each counter by its type, from rows with value, delta and elapsed seconds.

    Raw counters pass through; rates are delta per second; averages and fractions divide by
    the change of their base counter at the same instant; base rows are used up.
    """
    out = [*series, "counter_name", ts]
    kind = F.col("cntr_type")
    moved = deltas.filter("cntr_value_delta <> 0")
    raw = deltas.filter(kind.isin(*RAW_TYPES)).select(*out, F.col("cntr_value").cast("decimal(23,3)").alias("cntr_value"))
    rate = moved.filter(kind.isin(*RATE_TYPES)).select(
        *out, units.int_div("cntr_value_delta", "elapsed_seconds").cast("decimal(23,3)").alias("cntr_value"))
    join_key = lambda c: F.rtrim(F.regexp_replace(F.lower(F.col(c)), r"(\(.*| base.*)$", ""))
    base = moved.filter(kind == BASE_TYPE).select(
        *series, ts, join_key("counter_name").alias("_join"), F.col("cntr_value_delta").alias("_base"))
    over = moved.filter(kind.isin(AVERAGE_TYPE, FRACTION_TYPE)).withColumn("_join", join_key("counter_name"))
    joined = null_safe_join(over, base, [*series, ts, "_join"])
    whole = units.int_div("cntr_value_delta", "_base").cast("decimal(23,3)")
    exact = (F.col("cntr_value_delta").cast("decimal(19,0)") / F.col("_base")).cast("decimal(23,3)")
    ratio = joined.select(*out, F.when(F.col("cntr_type") == AVERAGE_TYPE, whole).otherwise(exact).alias("cntr_value"))
    return union_all(ratio, rate, raw)


def ratio_counters(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """100 * fraction / base at the same instant, matched by the normalised counter name."""
    frac = df.filter(F.col("cntr_type") == FRACTION_TYPE).withColumn("join_name", normalised_key("counter_name"))
    base = df.filter(F.col("cntr_type") == BASE_TYPE).select(
        *keys, normalised_key("counter_name").alias("join_name"), F.col("cntr_value").alias("_base"))
    joined = null_safe_join(frac, base, [*keys, "join_name"], "left")
    value = F.when(F.coalesce("_base", F.lit(0)) != 0, units.int_div(F.col("cntr_value") * 100, "_base")).otherwise(F.col("cntr_value"))
    return joined.withColumn("cntr_value", value).drop("join_name", "_base")


def two_sample_rate(first: DataFrame, second: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    """(v2 - v1) / seconds between two samples of each series (NULL keys match)."""
    a = first.select(*keys, F.col(ts).alias("time1"), F.col(value).alias("_v1"))
    b = second.select(*keys, F.col(ts).alias("time2"), F.col(value).alias("_v2"))
    j = null_safe_join(a, b, list(keys)).filter("time1 < time2")
    rate = units.int_div(F.col("_v2") - F.col("_v1"), clock.datediff_boundary("second", "time1", "time2"))
    return j.withColumn("rate", rate).drop("_v1", "_v2")


def wait_snapshot(df: DataFrame, by: Sequence[str], ignorable: Sequence[str] = IGNORABLE_WAITS) -> DataFrame:
    """Wait, resource and signal seconds with share and rank inside each snapshot."""
    d = exclude_values(df, "wait_type", ignorable).filter("waiting_tasks_count > 0")
    d = d.withColumns({
        "wait_s": F.col("wait_time_ms") / 1000.0,
        "resource_s": (F.col("wait_time_ms") - F.col("signal_wait_time_ms")) / 1000.0,
        "signal_s": F.col("signal_wait_time_ms") / 1000.0,
        "wait_count": F.col("waiting_tasks_count"),
    })
    d = with_group(d, by, _total=F.sum("wait_time_ms"))
    d = d.withColumn("percentage", F.col("wait_time_ms") * 100.0 / F.col("_total")).drop("_total")
    w = W.partitionBy(*by).orderBy(F.col("wait_time_ms").desc(), "wait_type")  # one row per wait type
    return d.withColumn("row_num", F.row_number().over(w))


def pareto(df: DataFrame, value: str, tie: Sequence[str], threshold: float = 95, by: Sequence[str] = ()) -> DataFrame:
    """Rows by falling value while the cumulative share before the row is below the threshold."""
    order = [F.col(value).desc(), *[F.col(t).asc() for t in tie]]
    d = running_sum_in(df, by, value, order, "_run")
    if by:
        d = with_group(d, by, _total=F.sum(value))
    else:
        d = d.withColumn("_total", d.agg(F.sum(value)).scalar())  # from the checkpoint, not from the source
    d = d.withColumn("percentage", F.col(value) * 100.0 / F.col("_total"))
    d = d.withColumn("cumulative", F.col("_run") * 100.0 / F.col("_total"))
    before = (F.col("_run") - F.col(value)) * 100.0 / F.col("_total")
    return d.filter(before < threshold).drop("_run", "_total")


def clear_ranges(clears: DataFrame, by: Sequence[str], point: str, start, end) -> DataFrame:
    """Ranges between start, the clear points inside, and end; first and last are flagged."""
    from opskit.operators.joins import to_ranges

    inner = clears.filter(F.col(point).between(start, end)).select(*by, point)
    keys = clears.select(*by).distinct()
    ends = keys.select(*by, F.explode(F.array(start, end)).alias(point))
    r = to_ranges(inner.unionByName(ends), point, by)
    return r.withColumn("is_first", F.col("range_id") == 1)


def wait_delta(
    snapshots: DataFrame, clears: DataFrame, by: Sequence[str], ts: str, clear_time: str, start, end, threshold: float = 95
) -> DataFrame:
    """Wait change over a period, split where the statistics were cleared.

    Inside each range the first and the last snapshot are compared over all wait types of
    either one.  Inner edges are exclusive, the outer two inclusive.  Shares and the Pareto
    cut are per range.
    """
    ranges = durable(clear_ranges(clears, by, clear_time, start, end))  # one row per clear
    cols = ["range_id", "lower", "upper", "is_first", "is_last"]
    hit = asof_join(snapshots.filter(F.col(ts).between(start, end)), ranges, by, ts, "lower", cols)
    # the end point itself belongs to the last range, which starts earlier
    inside = ((F.col(ts) > F.col("lower")) | (F.col("is_first") & (F.col(ts) == F.col("lower")))) & (
        (F.col(ts) < F.col("upper")) | (F.col("is_last") & (F.col(ts) == F.col("upper"))))
    rows = hit.filter(inside)
    rows = with_group(rows, [*by, "range_id"], _t1=F.min(ts), _t2=F.max(ts))
    rows = rows.filter((F.col(ts) == F.col("_t1")) | (F.col(ts) == F.col("_t2")))
    at = lambda c, t: F.sum(F.when(F.col(ts) == F.col(t), F.col(c)).otherwise(0))
    measures = ["wait_time_ms", "signal_wait_time_ms", "waiting_tasks_count"]
    d = rows.groupBy(*by, "range_id", "wait_type").agg(
        F.max("_t2").alias("collection_time"), clock.datediff_boundary("second", F.max("_t1"), F.max("_t2")).alias("duration_seconds"),
        *[(at(c, "_t2") - at(c, "_t1")).alias(c) for c in measures],
    ).filter("waiting_tasks_count > 0 and wait_time_ms >= 0")
    return pareto(d, "wait_time_ms", ["wait_type"], threshold, [*by, "range_id"])


def wait_delta_view(df: DataFrame, categories: DataFrame, keys: Sequence[str], ts: str, max_gap: int = 60) -> DataFrame:
    """Wait change per snapshot with its category (Other and not ignorable by default)."""
    d = counter_delta(
        df, [*keys, "wait_type"], ts, ["wait_time_ms", "signal_wait_time_ms", "waiting_tasks_count"],
        on_reset="drop", max_gap=max_gap, monotone=["wait_time_ms"])
    d = d.join(broadcast_if_small(categories), "wait_type", "left")
    return d.withColumns({
        "wait_category": F.coalesce("wait_category", F.lit("Other")),
        "ignorable": F.coalesce("ignorable", F.lit(0)),
        "wait_minutes_delta": F.col("wait_time_ms_delta") / 60000.0,
        "wait_minutes_per_minute": F.try_divide(F.col("wait_time_ms_delta") / 1000.0, F.col("elapsed_seconds")),
    })


def trend_text(df: DataFrame, keys: Sequence[str], ts: str, value: str, minutes: int, now, sep: str = " <- ") -> DataFrame:
    """Last ``minutes`` minutes, one sample per minute, newest first (at most ``minutes`` items)."""
    recent = df.filter(F.col(ts) >= now - F.make_dt_interval(mins=F.lit(minutes)))
    one = one_per_bucket(recent, ts, F.date_trunc("minute", ts), keys)
    items = F.sort_array(F.collect_list(F.struct(ts, F.col(value).cast("string").alias("v"))), asc=False)
    return one.groupBy(*keys).agg(F.array_join(F.transform(items, lambda x: x["v"]), sep).alias("trend"))


def per_cpu(samples: DataFrame, sysinfo: DataFrame, by: Sequence[str], ts: str, value: str, counters: Sequence[str]) -> DataFrame:
    """Divide machine-wide counters by the CPU count valid at the sample time."""
    j = asof_join(samples, sysinfo, by, ts, ts, ["cpu_count"])
    return j.withColumn(value, F.when(F.col("counter_name").isin(*counters), units.int_div(value, "cpu_count")).otherwise(F.col(value)))


def large_instances(df: DataFrame, instance: str, size_counter: str, limit) -> DataFrame:
    """All rows of instances whose size counter was ever above the limit."""
    big = df.filter((F.col("counter_name") == size_counter) & (F.col("cntr_value") > limit)).select(instance).distinct()
    return df.join(big, instance, "left_semi")
