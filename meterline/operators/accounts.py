"""Account forecasts on the weekly panel: populations, training rows, schedules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import fiscal


def _idle() -> Column:
    """The idle flag with unknown read as not idle, so that both populations cover all rows."""
    return F.coalesce(F.col("idle_12_weeks"), F.lit(False))


def _is_small() -> Column:
    return _idle() | (F.col("real") == 0)


def inactive_accounts(panel: DataFrame, weeks: int = C.INACTIVE_WEEKS) -> DataFrame:
    """Small or idle accounts of the newest week whose last use is too far back."""
    newest = panel.select(F.max("week")).scalar()
    return panel.where((F.col("week") == newest) & _is_small() & (F.col("end_week") < F.col("week") - weeks)).select(
        "account_id").distinct()


def account_population(panel: DataFrame, inactive: DataFrame) -> DataFrame:
    """Label panel rows real or small; inactive accounts leave the small population.

    They are looked up by account alone, so a dense panel whose accounts are dealt already is neither shuffled nor sorted again; a task
    holds its share of the inactive accounts, one row each.
    """
    labelled = panel.withColumn("population", F.when(_is_small(), "small").otherwise("real")).alias("panel")
    gone = inactive.select("account_id").hint("shuffle_hash").alias("gone")
    return labelled.join(gone, (F.col("panel.account_id") == F.col("gone.account_id")) & (F.col("panel.population") == "small"), "left_anti")


def panel_clean(panel: DataFrame) -> DataFrame:
    """Infinite values to null in every floating column."""
    def cleaned(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.when(F.abs(c) != float("inf"), c).alias(field.name)
        return c

    return panel.select(*[cleaned(f) for f in panel.schema.fields])


def usage_age_features(panel: DataFrame) -> DataFrame:
    return panel.select("*", (F.col("end_week") - F.col("start_week")).alias("usage_duration"),
                        (F.col("week") - F.col("start_week")).alias("weeks_since_first_use"))


def horizon_values(panel: DataFrame, steps: int) -> DataFrame:
    """Add ``later``: the values of the same account 1 to ``steps`` weeks after each week; null where it has no such week.

    Instead of a self join per step, one window over the account reads all later values: a
    range frame of exactly h weeks. One shuffle, whatever the number of steps, and a row stays a row.
    """
    by_week = Window.partitionBy("account_id").orderBy("week")
    return panel.withColumn("later", F.array(*[F.max("dollars").over(by_week.rangeBetween(h, h)) for h in range(1, steps + 1)]))


def direct_horizon_training(panel: DataFrame, steps: int) -> DataFrame:
    """Pair every week with the weeks 1 to ``steps`` later of the same account; gaps give no pair and the newest week drops out."""
    return (horizon_values(panel, steps)
            .select("*", F.posexplode("later").alias("step", "then")).where(F.col("then").isNotNull())
            .select(*panel.columns, (F.col("step") + 1).alias("week_ahead"), (F.col("then") - F.col("dollars")).alias("target")))


def forecast_schedule(predictions: DataFrame) -> DataFrame:
    """Predicted change plus last value, not below zero, dated by its step."""
    value = F.col("prediction") + F.col("dollars")
    return predictions.select(
        "account_id", F.greatest(value, F.lit(0).cast(predictions.schema["prediction"].dataType)).alias("forecast"),
        F.date_add(F.date_sub("train_date", 7), F.col("week_ahead") * 7).alias("week"), "train_date")


def zero_fill_inactive(forecast: DataFrame, inactive: DataFrame) -> DataFrame:
    """Zero rows for inactive accounts for every forecast week of the newest train date.

    The weeks form one short array (at most the horizon), so each account unfolds its own
    rows and nothing is joined.
    """
    newest = forecast.select(F.max("train_date")).scalar()
    slots = forecast.where(F.col("train_date") == newest).select("week", "train_date").distinct()
    listed = slots.select(F.array_sort(F.collect_list(F.struct("week", "train_date")))).scalar()
    zeros = inactive.select("account_id", F.explode(listed).alias("slot")).select(
        "account_id", F.lit(0).cast("decimal(18,4)").alias("forecast"), "slot.week", "slot.train_date")
    return forecast.select("account_id", "forecast", "week", "train_date").unionByName(zeros)


def account_monthly_eligible(monthly: DataFrame, cutoff: dt.date, horizon: int = C.ACCOUNT_MONTH_HORIZON,
                             min_rows: int = C.MIN_ROWS_FORECAST) -> DataFrame:
    """Accounts with enough rows in one source and recent data, with their history and future range."""
    month = fiscal.month_date("year", "month")
    per_source = monthly.groupBy("account_id", "source").agg(
        F.count("*").alias("rows"), F.min(month).alias("first"), F.max(month).alias("last"))
    spans = per_source.groupBy("account_id").agg(
        F.max("rows").alias("rows"), F.min("first").alias("first_month"), F.max("last").alias("last_month"))
    return spans.where((F.col("rows") > min_rows) & (F.col("last_month") >= F.lit(cutoff))).select(
        "account_id", "first_month", "last_month",
        F.last_day(F.add_months("last_month", 1)).alias("future_start"),
        F.last_day(F.add_months("last_month", horizon)).alias("future_end"))


def account_monthly_frame(series: DataFrame, eligible: DataFrame) -> DataFrame:
    """Monthly history of the eligible accounts plus one empty row per future month."""
    history = series.join(eligible.select("account_id"), "account_id", "left_semi").select(
        "account_id", F.last_day(fiscal.month_date("year", "month")).alias("date"), "dollars")
    months = F.sequence(fiscal.month_start("future_start"), F.col("future_end"), F.expr("interval 1 month"))
    ahead = eligible.select("account_id", F.explode(months).alias("month")).select(
        "account_id", F.last_day("month").alias("date"))
    return history.unionByName(ahead, allowMissingColumns=True)
