"""Allocation between months, weeks and days, and smoothing over vintages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import fiscal
from ..functions.money import TOTAL, WIDE


def _share(value: Column, days: Column, of_days: Column) -> Column:
    return (value.cast("double") * days / of_days).cast(WIDE)


def month_to_week(monthly: DataFrame) -> DataFrame:
    """Spread month values evenly over their days and sum by Monday week.

    A month touches at most six weeks, so it is unfolded to weeks with the number of shared
    days rather than to days.
    """
    first, last = fiscal.month_start("date"), F.last_day("date")
    weeks = F.sequence(fiscal.monday_of(first), last, F.expr("interval 7 days"))
    days = F.datediff(F.least(F.date_add("week", 6), F.col("last")), F.greatest(F.col("week"), F.col("first"))) + 1
    return (monthly.select("account_id", "train_date", "forecast", first.alias("first"), last.alias("last"),
                           F.explode(weeks).alias("week"))
            .select("account_id", "train_date", "week",
                    _share(F.col("forecast"), days, F.dayofmonth("last")).alias("forecast"))
            .groupBy("account_id", "week", "train_date").agg(F.sum("forecast").cast(WIDE).alias("forecast")))


def zero_fill_unforecast(forecast: DataFrame, accounts: DataFrame) -> DataFrame:
    """Zero rows for accounts without a forecast, for every (week, train date) there is.

    The slots are bounded by horizon and train dates; they travel as one array.
    """
    missing = accounts.select("account_id").distinct().join(forecast, "account_id", "left_anti")
    slots = forecast.select("week", "train_date").distinct()
    listed = slots.select(F.array_sort(F.collect_list(F.struct("week", "train_date")))).scalar()
    zeros = missing.select("account_id", F.explode(listed).alias("slot")).select(
        "account_id", F.lit(0).cast(WIDE).alias("forecast"), "slot.week", "slot.train_date")
    return forecast.select("account_id", "forecast", "week", "train_date").unionByName(zeros)


def combine_account_forecasts(real: DataFrame, small: DataFrame, monthly: DataFrame, newest_week: Column) -> DataFrame:
    """Sum the three parts per account, week and train date.

    Kept are weeks after the newest data week up to the last week of the real part, for the
    newest train date of the real part.
    """
    columns = ("account_id", "week", "train_date")
    parts = [p.select(*columns, F.col("forecast").cast(WIDE).alias("forecast")) for p in (real, small, monthly)]
    end = real.select(F.max("week")).scalar()
    train_date = real.select(F.max("train_date")).scalar()
    # the filter stands below the sums, so other train dates never reach the shuffle
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).where(
        (F.col("week") > newest_week) & (F.col("week") <= end) & (F.col("train_date") == train_date))
    return rows.groupBy(*columns).agg(F.sum("forecast").cast(WIDE).alias("forecast"))


def smooth_over_vintages(forecast: DataFrame, keys: list[str], span: int = C.EMA_SPAN) -> DataFrame:
    """Exponential mean over the train dates of each key, not adjusted.

    A null keeps the last value and raises the weight of the next one. There is one row per
    key and train date, so the list that is folded is as long as the number of train dates
    that look at the same target, which the forecast horizon bounds.
    """
    alpha = 2.0 / (span + 1)
    keep = 1.0 - alpha
    rows = F.array_sort(F.collect_list(F.struct("train_date", F.col("forecast").cast("double").alias("value"))))
    start = F.struct(F.lit(None).cast("double").alias("mean"), F.lit(0.0).alias("gap"),
                     F.array().cast("array<struct<train_date:date,forecast:double>>").alias("out"))

    def step(state: Column, row: Column) -> Column:
        weight = F.pow(F.lit(keep), state["gap"] + 1)
        mean = (F.when(row["value"].isNull(), state["mean"])
                .when(state["mean"].isNull(), row["value"])
                .otherwise((weight * state["mean"] + alpha * row["value"]) / (weight + alpha)))
        gap = F.when(row["value"].isNull() & state["mean"].isNotNull(), state["gap"] + 1).otherwise(F.lit(0.0))
        entry = F.named_struct(F.lit("train_date"), row["train_date"], F.lit("forecast"), mean)
        return F.named_struct(F.lit("mean"), mean, F.lit("gap"), gap, F.lit("out"), F.concat(state["out"], F.array(entry)))

    folded = F.aggregate("rows", start, step, lambda state: state["out"])
    return (forecast.groupBy(*keys).agg(rows.alias("rows"))
            .select(*keys, F.explode(folded).alias("s")).select(*keys, "s.train_date", "s.forecast"))


def weekday_share(usage: DataFrame, as_of: dt.date, days: int = C.WEEKDAY_WINDOW_DAYS) -> DataFrame:
    """Share of each weekday in the usage of the last days; one scan, seven rows after the sum."""
    recent = usage.where((F.col("date") >= F.date_sub(F.lit(as_of), days)) & (F.col("date") < F.lit(as_of)))
    sums = recent.groupBy(F.dayofweek("date").alias("weekday")).agg(F.sum("dollars").cast(TOTAL).alias("dollars"))
    # at most seven rows: list them in one row, divide by their sum, unfold again
    listed = sums.agg(F.collect_list(F.struct("weekday", "dollars")).alias("rows"), F.sum("dollars").alias("total"))
    return listed.select("total", F.explode("rows").alias("r")).select(
        "r.weekday", F.try_divide(F.col("r.dollars").cast("double"), F.col("total").cast("double")).alias("share"))


def week_to_day(weekly: DataFrame, shares: DataFrame) -> DataFrame:
    """Week values times weekday shares on their seven days.

    The range join becomes a narrow unfolding to days; the seven shares arrive as one map.
    """
    share = shares.select(F.map_from_entries(F.collect_list(F.struct("weekday", "share")))).scalar()
    return (weekly.select("account_id", "train_date", "forecast",
                          F.explode(F.sequence(F.col("week"), F.date_add("week", 6))).alias("date"), share.alias("shares"))
            .select("account_id", "date", "train_date",
                    (F.col("forecast").cast("double") * F.try_element_at("shares", F.dayofweek("date"))).alias("forecast")))


def monthly_actuals_to_daily(usage: DataFrame, monthly: DataFrame, end: dt.date) -> DataFrame:
    """Monthly actuals spread evenly over the days of their month, with the daily actuals."""
    sums = monthly.groupBy("account_id", F.last_day(fiscal.month_date("year", "month")).alias("last")).agg(
        F.sum("dollars").cast(TOTAL).alias("dollars"))
    days = F.sequence(fiscal.month_start("last"), F.col("last"))
    spread = sums.select("account_id", F.explode(days).alias("date"),
                         (F.col("dollars").cast("double") / F.dayofmonth("last")).alias("dollars"))
    daily = (usage.where(F.col("date") < F.lit(end)).groupBy("account_id", "date")
             .agg(F.sum("dollars").cast("double").alias("dollars")))
    return (spread.where(F.col("date") < F.lit(end)).withColumn("source", F.lit("monthly"))
            .unionByName(daily.withColumn("source", F.lit("daily"))))


def latest_train_date(history: DataFrame) -> DataFrame:
    return history.where(F.col("train_date") == history.select(F.max("train_date")).scalar())
