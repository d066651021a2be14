"""What the physical plans must and must not hold."""

import pytest

from millrace.ordered import Ordered
from millrace.plans import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["j04_asof", "j06_enrich_with_flag", "j07_point_in_polygon", "r03_consistent_hash", "u07_flag_duplicates", "g07_totals"])
def test_no_all_pairs_joins(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", ["w01_moving_average_ring", "w13_sliding_lists", "t06_unchanged_runs", "t05_session_summary"])
def test_one_shuffle_for_chained_windows(spark, sf, name):
    assert plan(QUERIES[name](spark, sf)).count("Exchange hashpartitioning") == 1


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(QUERIES["p02_filter"](spark, sf))
    assert "GreaterThan(l_quantity,45.0)" in text and "l_shipdate" not in text


def test_top_n_before_the_shuffle(spark, sf):
    assert plan(QUERIES["l04_retain_newest"](spark, sf)).count("WindowGroupLimit") == 2


def test_small_groups_are_not_split(events):
    assert not Ordered.of(events, "user_id", ["ts", "event_id"]).split
    assert Ordered.of(events, "user_id", ["ts", "event_id"], limit=10).split
