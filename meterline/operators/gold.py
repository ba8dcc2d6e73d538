"""Gold tables: the tall table, accuracy of plans and models, quarter totals by vintage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import fiscal
from ..functions.keys import key_region, key_segment
from ..functions.money import WIDE, mean
from . import vintages as V


def tall_table(tables: list[DataFrame]) -> DataFrame:
    """All silver rows with month label and quarters: actuals, and forecasts of their own quarter."""
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table)
    return (whole.select("*", F.date_format("date", "yyyy-MM").alias("month"),
                         fiscal.fiscal_code("vintage").alias("vintage_code"), fiscal.fiscal_code("date").alias("date_code"))
            .where((F.lower("series") == V.ACTUALS) | (F.col("vintage_code") == F.col("date_code"))))


def _unit_segment(region: Column, segment: Column) -> Column:
    """Segment of regions planned by segment; null for the folded ones."""
    return F.when(~region.isin(*C.FOLDED_RENAMED), segment)


def _accuracy_columns(rows: DataFrame) -> DataFrame:
    return rows.select("series", "plan_vintage", "platform", "region", "segment", F.lit(None).cast("string").alias("sku"),
                       "date", "plan_quantity", "plan_dollars", "actual_quantity", "actual_dollars",
                       "model_vintage", "model_quantity", "model_dollars")


def _actual_sums(actuals: DataFrame, *keys: Column) -> DataFrame:
    return actuals.groupBy(*keys, fiscal.month_start("date").alias("date")).agg(
        F.sum("quantity").alias("actual_quantity"), F.sum("dollars").cast(WIDE).alias("actual_dollars"))


def _first_plan(plan: DataFrame, first: DataFrame, kind: str) -> DataFrame:
    vintage = first.where(F.col("plan_kind") == kind).select("first_vintage").scalar()
    return plan.where(F.col("vintage") == vintage).select(
        F.lit(kind).alias("series"), F.col("vintage").alias("plan_vintage"), "platform", "region", "segment", "date",
        F.col("quantity").alias("plan_quantity"), F.col("dollars").alias("plan_dollars"))


def accuracy_by_platform(actuals: DataFrame, plan: DataFrame, first: DataFrame) -> DataFrame:
    """Month actuals by platform next to the first plan of the newest quarter.

    Model forecasts are not made by platform, so the model columns are null here.
    """
    sums = _actual_sums(actuals, F.col("platform"))
    plans = _first_plan(plan, first, "platform").drop("region", "segment")
    none = F.lit(None)
    return _accuracy_columns(sums.join(plans, ["platform", "date"], "left").select(
        "*", none.cast("string").alias("region"), none.cast("string").alias("segment"),
        none.cast("date").alias("model_vintage"), none.cast("double").alias("model_quantity"),
        none.cast(WIDE).alias("model_dollars")))


def monthly_first_vintage_in_quarter(monthly_forecast: DataFrame, as_of: dt.date) -> DataFrame:
    """Per key, the first monthly vintage of the quarter of ``as_of``, averaged over runs.

    One pass: runs are averaged per vintage, and the smallest vintage is picked per key by a
    join on the key's minimum.
    """
    current = monthly_forecast.where(
        F.col("is_active") & (fiscal.fiscal_code("vintage") == fiscal.fiscal_code(F.lit(as_of))))
    means = current.groupBy("ts_key", "vintage", "date").agg(*[mean(v).alias(v) for v in ("y_lower", "y", "y_upper")])
    first = current.groupBy("ts_key").agg(F.min("vintage").alias("vintage"))
    return means.join(first, ["ts_key", "vintage"])


def accuracy_by_unit(actuals: DataFrame, plan: DataFrame, first: DataFrame, daily: DataFrame,
                     monthly_forecast: DataFrame, as_of: dt.date) -> DataFrame:
    """Month actuals by region and segment next to the first plan and the first model vintage.

    The segment is null for folded regions, so joins on it are null-safe.
    """
    region, segment = F.col("region"), F.col("segment")
    sums = _actual_sums(actuals, region, _unit_segment(region, segment).alias("segment"))
    plans = _first_plan(plan, first, "business unit").drop("platform")
    quarter_first = V.newest_quarter(V.first_vintage_by_quarter(daily)).select("first_vintage").scalar()
    from_daily = daily.where(F.col("vintage") == quarter_first).select(
        "region", _unit_segment(region, segment).alias("segment"), F.col("vintage").alias("model_vintage"),
        fiscal.month_start("date").alias("date"), "quantity", "dollars")
    key = F.col("ts_key")
    from_monthly = monthly_first_vintage_in_quarter(monthly_forecast, as_of).select(
        key_region(key).alias("region"), _unit_segment(key_region(key), key_segment(key)).alias("segment"),
        V.first_vintage_of(daily, as_of).alias("model_vintage"), "date",
        F.lit(None).cast("double").alias("quantity"), F.col("y").cast(WIDE).alias("dollars"))
    models = from_daily.unionByName(from_monthly).groupBy("region", "segment", "model_vintage", "date").agg(
        F.sum("quantity").alias("model_quantity"), F.sum("dollars").cast(WIDE).alias("model_dollars"))
    a, p, m = sums.alias("a"), plans.alias("p"), models.alias("m")

    def same(other: str) -> Column:
        return ((F.col("a.region") == F.col(f"{other}.region")) & (F.col("a.date") == F.col(f"{other}.date"))
                & F.col("a.segment").eqNullSafe(F.col(f"{other}.segment")))

    joined = a.join(p, same("p"), "left").join(m, same("m"), "left")
    return _accuracy_columns(joined.select(
        "p.series", "p.plan_vintage", F.lit(None).cast("string").alias("platform"), "a.region", "a.segment", "a.date",
        "p.plan_quantity", "p.plan_dollars", "a.actual_quantity", "a.actual_dollars",
        "m.model_vintage", "m.model_quantity", "m.model_dollars"))


def quarter_to_date_accuracy(by_platform: DataFrame, by_unit: DataFrame, as_of: dt.date) -> DataFrame:
    """Closed months with an actual and a forecast; the running month is left out."""
    today = F.lit(as_of)
    return by_platform.unionByName(by_unit).where(
        F.col("actual_dollars").isNotNull()
        & (F.col("model_dollars").isNotNull() | F.col("plan_dollars").isNotNull())
        & (F.col("date") != fiscal.month_start(today))
        & (F.datediff(today, F.add_months("date", 1)) >= C.CLOSE_LAG_DAYS))


def total_quarter_by_vintage(frozen: DataFrame, monthly_actuals: DataFrame, daily: DataFrame,
                             monthly_forecast: DataFrame, as_of: dt.date) -> DataFrame:
    """What each vintage says its quarter comes to, from four disjoint parts.

    Daily actuals before the vintage come from its own frozen copy; monthly actuals before the
    monthly vintage it uses; daily forecasts from the vintage on; monthly forecasts from the
    last monthly actual on. ``as_of`` says which monthly actuals are known.
    """
    none = F.lit(None).cast("double").alias("quantity")
    labels = (F.lit(C.NO_PLATFORM).alias("platform"), F.lit(C.NO_SKU).alias("sku"))
    columns = ("platform", "region", "segment", "sku", "vintage", "forecast_type", "date", "quantity", "dollars")

    copies = (frozen.where((F.col("date") < F.col("vintage")) & (fiscal.fiscal_code("date") == F.col("fiscal_code")))
              .groupBy("region", "segment", "vintage", "date", "pulled_at")
              .agg(F.sum("quantity").alias("quantity"), F.sum("dollars").alias("dollars")))
    seen = copies.groupBy("region", "segment", "vintage", "date").agg(
        F.avg("quantity").alias("quantity"), mean("dollars").alias("dollars"))
    seen = seen.select("*", *labels, F.lit("actuals").alias("forecast_type"))

    known = monthly_actuals.where(F.col("date") < fiscal.month_start(F.lit(as_of)))
    # one monthly vintage per daily vintage, so that no actual is repeated
    used = V.monthly_vintage_asof(daily, monthly_forecast, fiscal.month_start("vintage")).groupBy("vintage").agg(
        F.max("monthly_vintage").alias("monthly_vintage"))
    sums = (known.groupBy("region", "segment", "date").agg(F.sum("dollars").alias("dollars"))
            .withColumn("fiscal_code", fiscal.fiscal_code("date")))
    limits = used.withColumn("fiscal_code", fiscal.fiscal_code("vintage"))
    monthly_seen = (sums.join(limits, "fiscal_code")
                    .where((F.col("date") < F.col("vintage")) & (F.col("date") < F.col("monthly_vintage")))
                    .select("region", "segment", "vintage", "date", "dollars", none, *labels,
                            F.lit("actuals").alias("forecast_type")))

    ahead = daily.where(F.col("date") >= F.col("vintage")).select(
        "platform", "region", "segment", "sku", "vintage", F.col("series").alias("forecast_type"), "date", none, "dollars")

    last_actual = known.select(F.max("date")).scalar()
    monthly_ahead = V.monthly_vintage_asof(daily, monthly_forecast, last_actual).select(
        "platform", "region", "segment", "sku", "vintage", F.lit("monthly forecast").alias("forecast_type"),
        "date", "quantity", "dollars")

    whole = None
    for part in (seen, monthly_seen, ahead, monthly_ahead):
        rows = part.select(*[F.col(c).cast(WIDE) if c == "dollars" else F.col(c) for c in columns])
        whole = rows if whole is None else whole.unionByName(rows)
    return whole


def _month_list() -> Column:
    months = F.transform(F.array_sort(F.collect_set("date")), lambda d: F.date_format(d, "MMMM yyyy"))
    return F.array_join(months, ", ").alias("overlap_months")


def overlap_months(accuracy: DataFrame) -> DataFrame:
    """Months of the accuracy table in order, in one cell; the set is bounded by the calendar."""
    return accuracy.agg(_month_list())


def dashboard_metadata(daily: DataFrame, monthly_forecast: DataFrame, plan: DataFrame, accuracy: DataFrame,
                       as_of: dt.date) -> DataFrame:
    """One row about the state of all tables; every value is a scalar of its own."""
    plan_dates = plan.select(F.to_date("as_of_date").alias("vintage"))
    base = accuracy.agg(F.max("date").alias("last_month"), _month_list())
    today = F.lit(as_of)
    return base.select(
        today.cast("timestamp").alias("refreshed_at"),
        daily.select(F.max("vintage")).scalar().alias("latest_daily_vintage"),
        monthly_forecast.select(F.max("vintage")).scalar().alias("latest_monthly_vintage"),
        V.first_vintage_of(daily, as_of).alias("first_daily_vintage_in_quarter"),
        V.first_vintage_of(plan_dates, as_of).alias("first_plan_date_in_quarter"),
        "overlap_months",
        F.date_format(today, "MMMM yyyy").alias("current_month"),
        F.next_day(today, "Mon").alias("next_refresh_date"),
        F.date_add(F.add_months("last_month", 1), C.CLOSE_LAG_DAYS).alias("accuracy_refresh_date"))
