"""Comparison of measured runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from opskit.operators.aggregates import row_winner
from opskit.operators.reshape import pivot_metrics


def compare_runs(df: DataFrame, index: Sequence[str], scenario: str, scenarios: Sequence[str], duration: str) -> DataFrame:
    """Average duration per scenario as columns and the fastest scenario of each row."""
    wide = pivot_metrics(df, index, scenario, scenarios, F.avg(duration))
    return row_winner(wide, scenarios, "best", "winner")
