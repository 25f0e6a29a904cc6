"""Down-sampling and tiered retention."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from opskit.functions import clock
from opskit.operators.aggregates import union_all


def rollup_avg(df: DataFrame, keys: Sequence[str], ts: str, minutes: int, values: Sequence[str], exact: bool = False) -> DataFrame:
    """Average per bucket and series; truncated to whole numbers unless ``exact``."""
    avg = lambda v: F.avg(v) if exact else F.avg(v).cast("bigint")
    return df.groupBy(clock.time_bucket(ts, minutes).cast("timestamp_ntz").alias(ts), *keys).agg(*[avg(v).alias(v) for v in values])


def rollup_first(df: DataFrame, ts: str, minutes: int, by: Sequence[str] = ()) -> DataFrame:
    """Whole first snapshot of every bucket (for cumulative counters), per series in ``by``."""
    firsts = df.groupBy(*by, clock.time_bucket(ts, minutes).alias("_bucket")).agg(F.min(ts).alias(ts)).select(*by, ts)
    return df.join(firsts, [*by, ts], "left_semi")


@dataclass(frozen=True)
class Tier:
    """Rows up to ``max_age_days`` old are kept at ``minutes`` resolution (0 means raw)."""

    name: str
    minutes: int
    max_age_days: int


class TierPolicy:
    """Raw data, then coarser tiers with age, then nothing.

    Ages are cut at whole days, so a tier boundary never splits a bucket and every bucket
    is built from all of its rows.
    """

    def __init__(self, tiers: Sequence[Tier], keys: Sequence[str], ts: str, values: Sequence[str], gauge: bool = True):
        self.tiers, self.keys, self.ts, self.values, self.gauge = list(tiers), list(keys), ts, list(values), gauge

    def _reduce(self, df: DataFrame, minutes: int) -> DataFrame:
        pick = [self.ts, *self.keys, *self.values]
        if minutes == 0:
            return df.select(*pick)
        if self.gauge:
            return rollup_avg(df, self.keys, self.ts, minutes, self.values).select(*pick)
        return rollup_first(df, self.ts, minutes, self.keys).select(*pick)

    def apply(self, df: DataFrame, now) -> dict[str, DataFrame]:
        """Content of every tier at ``now``; rows beyond the last tier are gone."""
        out, newer = {}, None
        for tier in self.tiers:
            edge = F.date_trunc("day", now - F.make_dt_interval(days=F.lit(tier.max_age_days))).cast("timestamp_ntz")
            part = df.filter(F.col(self.ts) >= edge)
            if newer is not None:
                part = part.filter(F.col(self.ts) < newer)
            out[tier.name] = self._reduce(part, tier.minutes)
            newer = edge
        return out

    def view(self, df: DataFrame, now) -> DataFrame:
        """All tiers as one relation with the tier's name."""
        return union_all(*[d.withColumn("tier", F.lit(n)) for n, d in self.apply(df, now).items()])
