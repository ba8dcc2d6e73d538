"""Edge cases on small inline frames."""

import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterline import config as C
from meterline.functions import fiscal
from meterline.operators import accounts as A
from meterline.operators import allocation as L
from meterline.operators import explain as X
from meterline.operators import forecasting as M
from meterline.operators import movement as W
from meterline.operators import publishing as P
from meterline.operators import series as S
from meterline.operators import vintages as V

D = dt.date


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("day, code, start, end", [
    (D(2020, 1, 31), 202004, D(2019, 11, 1), D(2020, 1, 31)),
    (D(2020, 2, 1), 202101, D(2020, 2, 1), D(2020, 4, 30)),
    (D(2020, 2, 29), 202101, D(2020, 2, 1), D(2020, 4, 30)),
    (D(2020, 4, 30), 202101, D(2020, 2, 1), D(2020, 4, 30)),
    (D(2020, 5, 1), 202102, D(2020, 5, 1), D(2020, 7, 31)),
    (D(2020, 10, 31), 202103, D(2020, 8, 1), D(2020, 10, 31)),
    (D(2020, 11, 1), 202104, D(2020, 11, 1), D(2021, 1, 31)),
    (D(2020, 12, 31), 202104, D(2020, 11, 1), D(2021, 1, 31)),
    (D(2021, 1, 1), 202104, D(2020, 11, 1), D(2021, 1, 31)),
])
def test_fiscal_edges(spark, day, code, start, end):
    df = spark.range(1).select(F.lit(day).alias("d")).select(
        fiscal.fiscal_code("d"), fiscal.quarter_start("d"), fiscal.quarter_end("d"))
    assert rows(df) == [(code, start, end)]


def test_fiscal_code_equals_written_out_rule(spark):
    """All days of ten years against the rule in words: February opens the next fiscal year."""
    days = spark.sql("SELECT explode(sequence(DATE'2015-01-01', DATE'2024-12-31')) AS d").select("d", fiscal.fiscal_code("d"))
    for day, code in rows(days):
        year = day.year if day.month == 1 else day.year + 1
        quarter = 4 if day.month in (11, 12, 1) else 1 + (day.month - 2) // 3
        assert code == year * 100 + quarter


@pytest.mark.parametrize("day, closed, vintage", [
    (D(2021, 1, 10), D(2020, 11, 1), D(2020, 12, 1)),
    (D(2021, 1, 11), D(2020, 12, 1), D(2021, 1, 1)),
    (D(2021, 2, 5), D(2020, 12, 1), D(2021, 1, 1)),
    (D(2021, 6, 30), D(2021, 5, 1), D(2021, 6, 1)),
])
def test_monthly_cutoffs(spark, day, closed, vintage):
    df = spark.range(1).select(fiscal.last_closed_month(F.lit(day), 10), fiscal.monthly_vintage_for(F.lit(day), 10))
    assert rows(df) == [(closed, vintage)]


def test_smoothing_fold_with_nulls(spark):
    values = [10.0, 20.0, None, 5.0, None, None, 7.0]
    data = [("a", D(2021, 1, 1) + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "account_id string, train_date date, forecast double")
    got = [r["forecast"] for r in L.smooth_over_vintages(df, ["account_id"]).orderBy("train_date").collect()]
    want = pd.Series(values).ewm(span=9, min_periods=1, adjust=False).mean().tolist()
    assert got == pytest.approx(want)
    assert got[-1] == pytest.approx(9.397004, abs=1e-6)


def test_smoothing_starts_with_null(spark):
    data = [("a", D(2021, 1, 1 + i), v) for i, v in enumerate([None, None, 4.0, 8.0])]
    df = spark.createDataFrame(data, "account_id string, train_date date, forecast double")
    got = [r["forecast"] for r in L.smooth_over_vintages(df, ["account_id"]).orderBy("train_date").collect()]
    assert got[:2] == [None, None] and got[2:] == pytest.approx([4.0, 4.8])


def test_month_spread_keeps_the_sum(spark):
    df = spark.createDataFrame([("a", D(2021, 3, 1), D(2021, 1, 31), 31.0), ("a", D(2021, 3, 1), D(2021, 2, 28), 28.0)],
                               "account_id string, train_date date, date date, forecast double")
    weeks = {r["week"]: float(r["forecast"]) for r in L.month_to_week(df).collect()}
    assert sum(weeks.values()) == pytest.approx(59.0)
    assert weeks[D(2020, 12, 28)] == pytest.approx(3.0)   # Fri to Sun, 1 to 3 January
    assert weeks[D(2021, 1, 4)] == pytest.approx(7.0)
    assert weeks[D(2021, 2, 22)] == pytest.approx(7.0)


def test_week_to_day_keeps_the_sum(spark):
    usage = spark.createDataFrame([(D(2021, 1, 1) + dt.timedelta(days=i), i + 1) for i in range(28)],
                                  "date date, n int").select("date", F.col("n").cast("decimal(18,4)").alias("dollars"))
    shares = L.weekday_share(usage, D(2021, 1, 29))
    assert sum(r["share"] for r in shares.collect()) == pytest.approx(1.0)
    weekly = spark.createDataFrame([("a", D(2021, 2, 1), D(2021, 1, 30), 70.0)],
                                   "account_id string, week date, train_date date, forecast double")
    days = L.week_to_day(weekly, shares).collect()
    assert len(days) == 7 and sum(r["forecast"] for r in days) == pytest.approx(70.0)


def test_zero_total_gives_null_strength(spark):
    data = [("a", D(2021, 1, 4), "q4", "account", f, 0.0) for f in ("x", "y", "z")]
    df = spark.createDataFrame(data, "account_id string, train_date date, quarter_explained string, kind string, "
                                     "feature string, contribution double")
    assert [r["strength"] for r in X.contribution_strength(df).collect()] == [None] * 3
    assert [r["strength"] for r in X.kind_strength(df).collect()] == [None]
    assert [r["direction"] for r in X.contribution_direction(df).collect()] == [0] * 3


def test_strengths_sum_to_one(spark):
    data = [("a", D(2021, 1, 4), "q4", k, f, v) for k, f, v in
            (("account", "x", -1.0), ("account", "y", 3.0), ("product", "z", 4.0))]
    df = spark.createDataFrame(data, "account_id string, train_date date, quarter_explained string, kind string, "
                                     "feature string, contribution double")
    got = {r["feature"]: r["strength"] for r in X.contribution_strength(df).collect()}
    assert got == {"x": 0.25, "y": 0.75, "z": 1.0}
    assert {r["kind"]: r["strength"] for r in X.kind_strength(df).collect()} == {"account": 0.5, "product": 0.5}
    assert {r["kind"]: r["direction"] for r in X.kind_direction(df).collect()} == {"account": 1, "product": 1}


def _panel(spark, data):
    return spark.createDataFrame(data, "account_id string, week int, end_week int, idle_12_weeks boolean, real int, dollars double")


def test_null_flag_belongs_to_one_population(spark):
    panel = _panel(spark, [("a", 10, 10, None, 1, 1.0), ("b", 10, 10, None, 0, 1.0), ("c", 10, 10, True, 1, 1.0),
                           ("d", 10, 2, False, 0, 1.0)])
    inactive = A.inactive_accounts(panel)
    assert rows(inactive) == [("d",)]
    got = {r["account_id"]: r["population"] for r in A.account_population(panel, inactive).collect()}
    assert got == {"a": "real", "b": "small", "c": "small"}


def test_horizon_pairs_respect_gaps(spark):
    panel = _panel(spark, [("a", 1, 9, False, 1, 10.0), ("a", 2, 9, False, 1, 12.0), ("a", 4, 9, False, 1, 20.0),
                           ("b", 2, 9, False, 1, 5.0)])
    got = {(r["account_id"], r["week"], r["week_ahead"]): r["target"] for r in A.direct_horizon_training(panel, 3).collect()}
    assert got == {("a", 1, 1): 2.0, ("a", 1, 3): 10.0, ("a", 2, 2): 8.0}


def test_infinities_become_null(spark):
    df = spark.createDataFrame([(1, float("inf")), (2, float("-inf")), (3, 1.5), (4, None)], "k int, v double")
    assert rows(A.panel_clean(df).orderBy("k")) == [(1, None), (2, None), (3, 1.5), (4, None)]


def test_schedule_clamps_at_zero(spark):
    df = spark.createDataFrame([("a", -5, 3, 1, D(2021, 1, 11)), ("a", 2, 3, 2, D(2021, 1, 11))],
                               "account_id string, prediction int, dollars int, week_ahead int, train_date date").select(
        "account_id", F.col("prediction").cast("decimal(18,4)").alias("prediction"),
        F.col("dollars").cast("decimal(18,4)").alias("dollars"), "week_ahead", "train_date")
    got = [(float(r["forecast"]), r["week"]) for r in A.forecast_schedule(df).orderBy("week").collect()]
    assert got == [(0.0, D(2021, 1, 11)), (5.0, D(2021, 1, 18))]


def test_one_word_unit_has_no_segment(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 2, 1), "Business Unit", "EUROPE", 2021, 3, 1.0),
                                (dt.datetime(2021, 2, 1), "Business Unit", "ASIA BIG PART", 2021, 3, 1.0),
                                (dt.datetime(2021, 2, 1), "Platform", "X", 2021, 3, 1.0)],
                               "as_of_date timestamp, plan_kind string, platform string, year int, month int, dollars double")
    got = sorted((r["region"], r["segment"]) for r in V.plan_by_unit(df).collect())
    assert got == [("ASIA PACIFIC", "BIG PART"), ("EUROPE", None)]
    assert [r["platform"] for r in V.plan_by_platform(df).collect()] == ["x"]


def _forecasts(spark, data, name="vintage"):
    return spark.createDataFrame(data, f"ts_key string, {name} date, date date, y double, is_active boolean")


def test_vintage_ties_and_late_vintages(spark):
    daily = V.forecast_daily_active(_forecasts(spark, [("AFRICABUILDINGy", D(2000, 11, 20), D(2000, 11, 20), 1.0, True)]))
    monthly = _forecasts(spark, [
        ("AFRICABUILDINGy", D(2000, 11, 1), D(2000, 12, 1), 1.0, True),
        ("AFRICABUILDINGy", D(2000, 11, 15), D(2000, 12, 1), 2.0, True),
        ("AFRICABUILDINGy", D(2000, 11, 15), D(2001, 1, 1), 3.0, True),   # same rank: other target month
        ("AFRICABUILDINGy", D(2000, 11, 15), D(2001, 2, 1), 4.0, True),   # next quarter
        ("AFRICABUILDINGy", D(2000, 12, 1), D(2001, 1, 1), 9.0, True),    # after the daily vintage
        ("AFRICABUILDINGy", D(2000, 11, 15), D(2001, 1, 1), 99.0, False)])
    got = sorted((r["date"], float(r["dollars"])) for r in V.monthly_vintage_asof(daily, monthly).collect())
    assert got == [(D(2000, 12, 1), 2.0), (D(2001, 1, 1), 3.0)]


def test_priority_of_monthly_sources(spark):
    columns = ("series string, detail string, display string, vintage date, platform string, region string, segment string, "
               "sku string, date date, quantity double, dollars double, monthly_vintage date")

    def row(detail, month, value):
        return ("s", detail, "d", D(2000, 11, 20), "p", "r", "g", "k", month, None, value, None)

    asof = spark.createDataFrame([row(V.AHEAD_MONTHLY, D(2000, 12, 1), 1.0)], columns)
    repeated = spark.createDataFrame([
        row("future forecast - padded actuals private", D(2000, 12, 1), 2.0),
        row("future forecast - padded actuals private", D(2000, 11, 1), 3.0),
        row("future forecast - padded actuals private", D(2000, 11, 1), 4.0),   # tie: both stay
        row("future forecast - padded actuals public", D(2000, 11, 1), 5.0)], columns).drop("monthly_vintage")
    got = sorted(r["dollars"] for r in V.monthly_repeated(asof, repeated).collect())
    assert got == [1.0, 3.0, 4.0]


def test_carved_out_series_leaves_its_parent(spark):
    snapshot = spark.createDataFrame(
        [(C.CARVE_OUT_PARENT, 300_000.0, D(2001, 1, 29)), (C.CARVE_OUT_KEY, 120_000.0, D(2001, 1, 29)),
         ("EUROPEALL", 99_999.0, D(2001, 1, 29))], "unit_key string, v double, vintage date").select(
        "unit_key", "vintage", *[F.col("v").cast("decimal(28,6)").alias(b) for b in P.BOUNDS])
    names = spark.createDataFrame([(C.CARVE_OUT_PARENT, "Parent", 1), ("EUROPEALL", "Europe", 2), (C.CARVE_OUT_KEY, "House", 3)],
                                  "unit_key string, display_name string, position int")
    residual = P.carve_out_residual(snapshot, names)
    assert {r["display_name"]: float(r["forecast"]) for r in residual.collect()} == {
        "Parent": 180_000.0, "Europe": 99_999.0, "House": 120_000.0}
    report = {r["display_name"]: (r["position"], r["forecast"]) for r in P.report_table(residual).collect()}
    assert report == {"Parent": (1, 200_000), "Europe": (2, 100_000), "House": (3, 200_000), "Total": (4, 500_000)}


def test_ensemble_folds_then_averages(spark):
    key, own = C.CARVE_OUT_PARENT + "y", C.CARVE_OUT_KEY + "y"
    day = D(2001, 1, 1)
    data = [(key, "a", 10.0), (own, "a", 5.0), (key, "b", 21.0)]
    df = spark.createDataFrame(data, "ts_key string, model string, v double").select(
        "ts_key", "model", F.lit(day).alias("date"), F.lit(day).alias("vintage"),
        *[F.col("v").cast("decimal(18,4)").alias(c) for c in P.VALUES])
    assert [(r["ts_key"], float(r["y"])) for r in P.ensemble_average(df).collect()] == [(key, 18.0)]


def test_replace_vintage_swaps_whole_vintages(spark):
    old = spark.createDataFrame([("a", D(2001, 1, 1), 1.0), ("a", D(2001, 1, 8), 2.0), ("b", D(2001, 1, 8), 3.0)],
                                "ts_key string, vintage date, y double")
    new = spark.createDataFrame([("a", D(2001, 1, 8), 9.0)], "ts_key string, vintage date, y double")
    got = sorted((r["ts_key"], r["vintage"], r["y"]) for r in P.replace_vintage(old, new).collect())
    assert got == [("a", D(2001, 1, 1), 1.0), ("a", D(2001, 1, 8), 9.0)]


def test_renamed_account_repeats_no_rows(spark):
    usage = spark.createDataFrame([("1", "Old", "u", "s", D(2001, 1, 1)), ("1", "New", "u", "s", D(2001, 2, 1))],
                                  "account_id string, account_name string, unit string, sub_unit string, date date")
    assert W.account_mapping(usage).count() == 2
    assert [r["account_name"] for r in W.latest_mapping(usage).collect()] == ["New"]


def test_movement_repeats_actuals_before_each_run(spark):
    usage = spark.createDataFrame([("1", D(2001, 8, 1), 1), ("1", D(2001, 8, 9), 2), ("1", D(2001, 7, 1), 50)],
                                  "account_id string, date date, n int").select(
        "account_id", "date", F.col("n").cast("decimal(18,4)").alias("dollars"))
    mapping = spark.createDataFrame([("1", "n", "u", "s")], "account_id string, account_name string, unit string, sub_unit string")
    runs = spark.createDataFrame([(D(2001, 8, 6),), (D(2001, 8, 13),), (D(2001, 8, 13),)], "run_date date")
    got = sorted((r["run_date"], r["forecast"]) for r in
                 W.actual_to_date_by_run(usage, mapping, runs, D(2001, 8, 1)).collect())
    assert got == [(D(2001, 8, 6), 1.0), (D(2001, 8, 13), 1.0), (D(2001, 8, 13), 2.0)]


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([("s", 0, 100, 110), ("s", 1, 200, 190), ("s", 2, 0, 5)],
                               "k string, block int, a int, f int").select(
        "k", "block", F.col("a").cast("decimal(18,4)").alias("actual"), F.col("f").cast("decimal(18,4)").alias("forecast"))
    got = M.forecast_metrics(df, ["k"], F.col("block")).first()
    assert got["rmse"] == pytest.approx(math.sqrt((100 + 100 + 25) / 3), abs=1e-4)
    assert got["mae"] == pytest.approx(25 / 3, abs=1e-4)
    assert got["mape"] == pytest.approx((0.1 + 0.05) / 2 * 100)
    assert got["share_outside"] == pytest.approx(2 / 3, abs=1e-6)


def test_incomplete_run_stops_the_job(spark):
    df = spark.createDataFrame([("a", D(2001, 1, 1)), ("b", D(2001, 1, 1)), ("a", D(2001, 1, 8))], "ts_key string, vintage date")
    expected = spark.createDataFrame([("a",), ("b",)], "ts_key string")
    checked = M.completeness_check(df, "ts_key", ["vintage"], 1, expected)
    assert {r["vintage"]: r["complete"] for r in checked.collect()} == {D(2001, 1, 1): True, D(2001, 1, 8): False}
    with pytest.raises(ValueError):
        M.require_complete(checked)
    lost = M.completeness_check(df, "ts_key", ["vintage"], 1, expected.union(spark.createDataFrame([("c",)], "ts_key string")))
    assert not any(r["complete"] for r in lost.collect())


def test_account_needs_rows_in_one_source(spark):
    data = [("a", "private", 2001, m, 1.0) for m in (1, 2)] + [("a", "public", 2001, m, 1.0) for m in (1, 2)]
    data += [("b", "private", 2001, m, 1.0) for m in (1, 2, 3, 3)]
    df = spark.createDataFrame(data, "account_id string, source string, year int, month int, v double").withColumn(
        "dollars", F.col("v").cast("decimal(18,4)"))
    got = sorted((r["account_id"], r["month"], float(r["dollars"])) for r in S.account_monthly_series(df).collect())
    assert got == [("b", 1, 1.0), ("b", 2, 1.0), ("b", 3, 2.0)]


def test_lags_follow_the_calendar(spark):
    from decimal import Decimal

    days = spark.createDataFrame(
        [("u", dt.date(2000, 1, d), Decimal(v)) for d, v in ((1, 10), (5, 20), (6, 30), (9, 40))], "unit string, date date, dollars decimal(18,4)")
    got = {r["date"].day: r for r in S.lag_features(days, "unit", (1, 4), (1, 7)).collect()}
    assert [got[d]["lag_1"] for d in (1, 5, 6, 9)] == [None, None, 20, None]
    assert [got[d]["lag_4"] for d in (1, 5, 6, 9)] == [None, 10, None, 20]
    assert got[9]["mean_lag"] == 25 and got[1]["mean_lag"] is None
