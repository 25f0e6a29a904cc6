"""Every registered report against its SQL, on the given tables and on skewed copies."""

import pytest

import __spark_entry__ as entry
import oracle_check
import skewed

QUERIES, SQL = entry.queries(), entry.oracle_sql()

# reports whose operators take special care of hot keys
SKEW = [
    "C11_asof_backward", "C14_interval_join", "C17_points_to_ranges", "C25_contains_join", "C26_longest_prefix", "E05_snapshot_number", "E08_ntile",
    "E11_group_size", "E15_global_running_sum", "H10_hierarchy", "I01_counter_delta", "I11_pareto", "I12_wait_delta", "I38_consecutive_failures",
    "I53_interleave", "J15_duplicates_by_month", "J30_duplicate_accounts", "K13_nest", "M05_stream_delta", "Q09_duplicate_definitions",
]


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle_check.connect(sf_dir)


@pytest.fixture(scope="module")
def hot_dir(sf_dir, tmp_path_factory):
    return skewed.build(sf_dir, str(tmp_path_factory.mktemp("hot")))


@pytest.fixture(scope="module")
def hot_duck(hot_dir):
    return oracle_check.connect(hot_dir)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_report_matches_sql(spark, sf_dir, duck, key):
    got = QUERIES[key](spark, sf_dir).toPandas()
    if key in SQL:
        assert oracle_check.diff(got, duck.execute(SQL[key]).df()) is None
    else:
        assert len(got) > 0


@pytest.mark.parametrize("key", SKEW)
def test_report_matches_sql_when_a_key_is_hot(spark, hot_dir, hot_duck, key):
    got = QUERIES[key](spark, hot_dir).toPandas()
    assert oracle_check.diff(got, hot_duck.execute(SQL[key]).df()) is None


def test_every_sql_belongs_to_a_report():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "cents", "percentage", "cumulative"]
    assert df.count() > 0
