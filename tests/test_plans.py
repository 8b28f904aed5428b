"""What the plans must look like, whatever the data size."""

import pytest

from harborline.plans.catalog import all_queries

def plan(spark, name, folder):
    return all_queries()[name](spark, folder)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["latest_vehicle_state", "air_recovery_options", "stg_ships_dedup"])
def test_one_row_per_key_is_cut_before_the_shuffle(spark, sf_dir, name):
    text = plan(spark, name, sf_dir)
    assert "WindowGroupLimit" in text and ", Partial" in text


def test_dimensions_are_broadcast(spark, sf_dir):
    text = plan(spark, "air_recovery_options", sf_dir)
    assert text.count("BroadcastHashJoin") >= 5


def test_best_option_needs_no_second_shuffle_by_ship(spark, sf_dir):
    text = plan(spark, "air_recovery_options", sf_dir)
    assert text.count("Exchange hashpartitioning(ship_id") == 1


def test_scans_read_only_the_needed_columns(spark, sf_dir):
    text = plan(spark, "otif_by_customer", sf_dir)
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in text
    assert "ReadSchema: struct<l_orderkey:bigint>" in text
    weather = plan(spark, "weather_severity", sf_dir)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in weather


def test_horizon_windows_share_one_sort(spark, sf_dir):
    text = plan(spark, "stock_horizon", sf_dir)
    assert text.count("Window [") >= 2
    assert text.count("Exchange rangepartitioning") == 0


def test_order_lines_are_read_once_more_at_most_after_the_totals(spark, sf_dir):
    """The totals are written rows by then; coverage carries what the horizon needs."""
    assert plan(spark, "stock_horizon", sf_dir).split("Initial Plan")[-1].count("lineitem.parquet") == 1
    assert plan(spark, "weekly_demand", sf_dir).split("Initial Plan")[-1].count("lineitem.parquet") == 1
