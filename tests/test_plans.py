"""Plans: usage is scanned once per grain, and raw rows are never unfolded before they are summed."""

import re

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def usage_scans(plan):
    return len(re.findall(r"Relation \[[^\]]*l_orderkey", plan))


@pytest.mark.parametrize(("name", "most"), [
    ("future_frame_daily", 0), ("calendar_regressors_daily", 0), ("event_regressors", 0), ("holiday_regressors", 0), ("growth_curve_features", 0),
    ("growth_terms", 0), ("seasonal_terms", 0), ("changepoint_terms", 0),  # read the stored daily sums
    ("inactive_accounts", 0), ("account_population", 0), ("forecast_schedule", 0),  # read the stored weekly sums
    ("combine_account_forecasts", 0), ("zero_fill_inactive", 0),
    ("quarter_outlook", 2), ("week_to_day", 2),  # shares of weekdays are sums of another grain
    ("unit_daily_series", 1), ("freeze_actuals", 1), ("ensemble_average", 0), ("tall_table", 0),
])
def test_usage_is_scanned_once_per_grain(spark, sf_dir, name, most):
    assert usage_scans(plan_of(QUERIES[name](spark, sf_dir))) <= most


@pytest.mark.parametrize("name", ["freeze_actuals", "quarter_snapshot", "total_quarter_by_vintage"])
def test_usage_is_summed_before_it_is_unfolded(spark, sf_dir, name):
    """No Generate stands between an aggregate and the raw usage: below each there is a sum already."""
    from meterline.plans import inputs as I
    lines = plan_of(I.usage_snapshots(spark, sf_dir)).splitlines()
    first = min(i for i, line in enumerate(lines) if "Generate" in line)
    assert any("Aggregate" in line for line in lines[first:]) and not any("Generate" in line for line in lines[first + 1:])
    assert QUERIES[name](spark, sf_dir).columns


@pytest.mark.parametrize("name", ["feature_assembly", "account_population"])
def test_dense_panel_is_neither_stored_nor_shuffled(spark, sf_dir, name):
    """Also where the inactive accounts are too many to broadcast: nothing above the idle weeks moves or sorts them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    unfolded = min(i for i, line in enumerate(lines) if "Generate explode" in line)
    assert not [line for line in lines[:unfolded] if re.search(r"Exchange|Sort|FileScan", line)]
