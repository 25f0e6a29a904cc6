"""Job history: durations, histograms, failed steps, schedules, balancing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from opskit.functions import clock
from opskit.operators.filters import RUN_STATUS, decode
from opskit.operators.ordered import first_per_key, global_row_number, ntile_in, top_per_key

# Lower bounds in hours of the duration buckets.
HOURS = (48, 36, 24, 18, 12, 9, 6, 3)
BUCKETS = ["<3-Hrs", *[f"{h}-Hrs" for h in reversed(HOURS)]]
DAYS = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")
RELATIVE = {1: "First", 2: "Second", 4: "Third", 8: "Fourth", 16: "Last"}
RELATIVE_DAY = {1: "Sun", 2: "Mon", 3: "Tue", 4: "Wed", 5: "Thu", 6: "Fri", 7: "Sat", 8: "Day", 9: "Weekday", 10: "Weekend"}


def duration_bucket(minutes: Column) -> Column:
    out = None
    for h in HOURS:
        cond = F.floor(minutes / 60) >= h
        out = F.when(cond, f"{h}-Hrs") if out is None else out.when(cond, f"{h}-Hrs")
    return out.otherwise(BUCKETS[0])


def duration_histogram(history: DataFrame) -> DataFrame:
    """Runs per job and duration bucket, with the newest run id."""
    runs = history.filter("step_id = 0").withColumn("bucket", duration_bucket(clock.hhmmss_to_minutes("run_duration")))
    counts = [F.count(F.when(F.col("bucket") == b, 1)).alias(b) for b in BUCKETS]
    return runs.groupBy("job_name").agg(F.max("instance_id").alias("instance_id"), *counts)


def merge_histogram(old: DataFrame, new: DataFrame) -> DataFrame:
    """Add the counts of new runs to the stored ones and move the high-water run id."""
    b = new.select("job_name", F.col("instance_id").alias("_id"), *[F.col(f"`{c}`").alias(f"n_{i}") for i, c in enumerate(BUCKETS)])
    j = old.join(b, "job_name", "full")
    add = lambda c, i: (F.coalesce(F.col(f"`{c}`"), F.lit(0)) + F.coalesce(F.col(f"n_{i}"), F.lit(0))).alias(c)
    return j.select("job_name", F.coalesce("_id", "instance_id").alias("instance_id"), *[add(c, i) for i, c in enumerate(BUCKETS)])


def last_duration(history: DataFrame) -> DataFrame:
    """Duration (h:m) of the last run per status as columns, and the first known of them."""
    minutes = clock.hhmmss_to_minutes("run_duration", "plus31")
    d = history.filter("step_id = 0").withColumns({
        "status": decode("run_status", RUN_STATUS), "run_time_at": clock.int_datetime("run_date", "run_time"),
        "duration": F.concat(F.floor(minutes / 60).cast("string"), F.lit(":"), (minutes % 60).cast("string")),
    }).filter("status is not null")
    last = first_per_key(d, ["job_name", "status"], [F.col("run_time_at").desc(), F.col("duration").desc()])
    names = ["Succeeded", "Canceled", "Failed", "Retry"]
    wide = last.groupBy("job_name").agg(*[F.max(F.when(F.col("status") == n, F.col("duration"))).alias(n.lower()) for n in names])
    return wide.withColumn("last_duration", F.coalesce(*[n.lower() for n in names]))


def failed_steps(history: DataFrame) -> DataFrame:
    """Failed steps of each job's latest run: after its second-latest job outcome row."""
    marks = top_per_key(history.filter("step_id = 0"), ["job_name"], [F.col("instance_id").desc()], 2)
    after = marks.groupBy("job_name").agg(F.min("instance_id").alias("_after"))
    return history.filter("step_id <> 0 and run_status = 0").join(after, "job_name").filter("instance_id > _after").drop("_after")


def describe_schedule(df: DataFrame) -> DataFrame:
    """Schedule codes as text: frequency, interval, time of day and next run."""
    f = F.col
    kind, every = f("freq_type"), f("freq_recurrence_factor").cast("string")
    repeated = lambda unit, one: F.when(f("freq_recurrence_factor") > 1, F.concat(F.lit("Every "), every, F.lit(f" {unit}s"))).otherwise(one)
    frequency = (
        F.when(kind == 1, "Once").when(kind == 4, "Daily").when(kind == 8, repeated("Week", "Weekly"))
        .when(kind == 16, repeated("Month", "Monthly")).when(kind == 32, F.concat(F.lit("Every "), every, F.lit(" Months")))
        .when(kind == 64, "SQL Startup").when(kind == 128, "SQL Idle").otherwise("??")
    )
    days = F.concat(*[
        F.when(f("freq_interval").bitwiseAND(F.lit(1 << i)) != 0, f"{d} ").otherwise("") for i, d in enumerate(DAYS)])
    interval = (
        F.when(kind == 1, "One time only")
        .when((kind == 4) & (f("freq_interval") == 1), "Every Day")
        .when((kind == 4) & (f("freq_interval") > 1), F.concat(F.lit("Every "), f("freq_interval").cast("string"), F.lit(" Days")))
        .when(kind == 8, days)
        .when(kind == 16, F.concat(F.lit("Day "), f("freq_interval").cast("string")))
        .when(kind == 32, F.concat(decode("freq_relative_interval", RELATIVE, "??"), F.lit(" "), decode("freq_interval", RELATIVE_DAY, "??")))
    )
    clock_text = lambda c: F.regexp_replace(F.lpad(f(c).cast("string"), 6, "0"), r"^(\d\d)(\d\d)(\d\d)$", "$1:$2:$3")
    sub = f("freq_subday_type")
    n = f("freq_subday_interval").cast("string")
    at = (
        F.when(sub == 1, clock_text("active_start_time"))
        .when(sub == 2, F.concat(F.lit("Every "), n, F.lit(" seconds")))
        .when(sub == 4, F.concat(F.lit("Every "), n, F.lit(" minutes")))
        .when(sub == 8, F.concat(F.lit("Every "), n, F.lit(" hours")))
        .otherwise("??")
    )
    nxt = F.when(f("next_run_date") == 0, "n/a").otherwise(
        F.concat(F.regexp_replace(f("next_run_date").cast("string"), r"^(\d{4})(\d\d)(\d\d)$", "$1-$2-$3"), F.lit(" "), clock_text("next_run_time")))
    return df.withColumns({"frequency": frequency, "interval": interval, "at": at, "next_run": nxt})


def balance(df: DataFrame, size: str, n: int, tie: Sequence[str]) -> DataFrame:
    """Spread work over ``n`` batches by size rank."""
    ranked = global_row_number(df, [F.col(size).desc(), *[F.col(t) for t in tie]], "size_rank")
    return ranked.withColumn("batch", F.col("size_rank") % n + 1)


def interleave(df: DataFrame, flag: str, size: str, tie: Sequence[str], n: int | None = None) -> DataFrame:
    """Order two work lists so that they alternate: tile of the position inside its list."""
    order = [F.col(size).desc(), *[F.col(t) for t in tie]]
    if n is None:
        smaller = df.groupBy(flag).agg(F.count("*").alias("c"))
        pair = smaller.agg(F.min("c").alias("c"), F.count("*").alias("k")).first()
        n = pair["c"] if pair["k"] > 1 else 50
    tiled = ntile_in(df, int(n), [flag], order, "tile", rank_out="order_id")
    return global_row_number(tiled, ["tile", "order_id", flag], "position")


def classify(rules: Sequence[tuple[str, dict]], default: str) -> Column:
    """First rule whose {column: pattern} pairs all match, else the default class."""
    from opskit.operators.filters import any_pattern

    out = None
    for name, pairs in rules:
        cond = any_pattern([pairs])
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise(default)
