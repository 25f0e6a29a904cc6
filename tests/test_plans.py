"""Shape of the physical plans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from opskit.operators import ordered as od

BATCH = sorted(k for k in entry.queries() if not k.startswith("M"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", [
    "I01_counter_delta", "I07_interpret_counters", "I11_pareto", "I19_blocking_tree", "I30_top_statements", "C06_attach_scalar", "C11_asof_backward",
    "C14_interval_join", "C22_null_aware_anti", "C25_contains_join", "C26_longest_prefix", "E06_surrogate_id", "J01_interesting_unanswered", "K05_merge_full", "K14_enlarge",
])
def test_no_pair_building_and_no_python(spark, sf_dir, key):
    p = plan(entry.queries()[key](spark, sf_dir))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|EvalPython|InPandas", p)


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    p = plan(entry.queries()["A01_read_metric"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p
    assert "user_id" not in p and "props" not in p


def test_first_per_key_is_cut_before_the_shuffle(db):
    p = plan(od.first_per_key(db.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]))
    assert p.index("Final") < p.index("Exchange") < p.index("Partial")


def test_global_window_sees_one_row_per_partition(db):
    df = od.global_row_number(db.customer.select("c_custkey"), ["c_custkey"])
    single = [b for b in plan(df).split("Window [")[1:] if "SinglePartition" in b]
    assert single and all("HashAggregate(keys=[_part" in b for b in single)


def test_series_windows_are_partitioned_by_slice(db):
    p = plan(od.series_lag(db.events, ["user_id"], ["ts", "event_id"], ["value"]))
    assert re.search(r"Window \[lag\(_pay#\d+, -1, null\).*_slice", p)


def test_a_large_table_is_not_broadcast(db, monkeypatch):
    from opskit.operators import joins as jn

    monkeypatch.setattr(jn, "BROADCAST_BYTES", 10)
    assert jn.is_small(db.region, 10, 1000) and not jn.is_small(db.region, 2) and not jn.is_small(db.region, 10, 10)
    assert F.broadcast(db.region) is not None
