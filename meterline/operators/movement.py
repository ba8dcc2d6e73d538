"""Account movement: actuals to date plus forecast, per account and run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.money import TOTAL

NAMES = ("account_name", "unit", "sub_unit")


def account_mapping(usage: DataFrame) -> DataFrame:
    """Distinct account, name, unit and sub-unit."""
    return usage.select("account_id", *NAMES).distinct()


def latest_mapping(usage: DataFrame) -> DataFrame:
    """One row per account, by its newest usage: a renamed account repeats no rows."""
    newest = F.max_by(F.struct(*NAMES), F.struct(F.col("date"), *NAMES)).alias("newest")
    # newest date of each combination first: a hash aggregate over the raw rows, the sorted one sees few
    dated = usage.groupBy("account_id", *NAMES).agg(F.max("date").alias("date"))
    return dated.groupBy("account_id").agg(newest).select("account_id", "newest.*")


def forecast_without_monthly_accounts(forecast: DataFrame, private: DataFrame, public: DataFrame,
                                      first: dt.date, last: dt.date) -> DataFrame:
    """Daily account forecasts in a date range, accounts of the monthly sources removed."""
    monthly = private.select("account_id").union(public.select("account_id")).distinct()
    return forecast.where(F.col("date").between(F.lit(first), F.lit(last))).join(monthly, "account_id", "left_anti")


def actual_to_date_by_run(usage: DataFrame, mapping: DataFrame, runs: DataFrame, first: dt.date) -> DataFrame:
    """Daily actuals of an account, repeated for each run date after them.

    The run dates are one short sorted array (at most one per day of the range); each day of
    an account keeps those after it and unfolds them, so there is no product of two tables.
    Usage is summed per account and day first, which takes the heat out of a hot account.
    """
    daily = (usage.where(F.col("date") >= F.lit(first)).groupBy("account_id", "date")
             .agg(F.sum("dollars").cast(TOTAL).alias("dollars")))
    listed = runs.select("run_date").distinct().select(F.array_sort(F.collect_list("run_date"))).scalar()
    later = F.filter(F.col("runs"), lambda run: run > F.col("date"))
    return (daily.join(mapping, "account_id").withColumn("runs", listed)
            .select("account_id", *NAMES, "date", F.explode(later).alias("run_date"),
                    F.col("dollars").cast("double").alias("forecast")))


def account_movement(forecast: DataFrame, actuals: DataFrame, mapping: DataFrame) -> DataFrame:
    """Forecast and actual rows of every run with the refresh dates of the newest one."""
    columns = ("account_id", *NAMES, "run_date", "forecast")
    newest = forecast.select(F.max("run_date")).scalar()
    ahead = forecast.join(mapping, "account_id").select(*columns)
    return ahead.unionByName(actuals.select(*columns)).select(
        *columns, F.date_add(newest, C.REFRESH_DAYS).alias("refreshed_on"),
        F.date_add(newest, C.NEXT_UPDATE_DAYS).alias("next_update_on"))
