"""Silver tables: frozen actuals, forecasts by vintage, plans.

Usage is summed to (platform, region, segment, kind, day) before any join, so every join
below is between tables whose size is set by the calendar and the unit list. They carry no
broadcast hint: adaptive execution measures both sides and broadcasts the one that is small
enough, or shuffles both.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import fiscal
from ..functions.keys import key_region, key_segment, renamed_region
from ..functions.money import TOTAL, WIDE, mean

SILVER = ("series", "detail", "display", "vintage", "platform", "region", "segment", "sku", "date", "quantity", "dollars")
ACTUALS, AHEAD, AHEAD_MONTHLY = "actuals", "future forecast", "future forecast - monthly"
MONTHLY_ACTUALS = "actuals - monthly"


def _silver(rows: DataFrame, series: str | Column, detail: str | Column, display: str | Column, keep: tuple[str, ...] = (),
            **columns: Column) -> DataFrame:
    """Select the silver columns; those not given are taken from ``rows`` by name."""
    labels = {"series": F.lit(series), "detail": F.lit(detail), "display": F.lit(display),
              "quantity": F.lit(None).cast("double")}  # F.lit leaves columns as they are
    given = {**labels, "dollars": F.col("dollars").cast(WIDE), **columns}
    return rows.select(*[given.get(c, F.col(c)).alias(c) for c in SILVER], *[F.col(c) for c in keep])


def _no_date() -> Column:
    return F.lit(None).cast("date")


# --- actuals -----------------------------------------------------------------------------


def new_vintages(forecast: DataFrame, frozen: DataFrame | None) -> DataFrame:
    """Active (vintage, run) pairs without a frozen copy, with the fiscal quarter."""
    runs = forecast.where("is_active").select("vintage", "score_run_at").distinct()
    if frozen is not None:
        done = frozen.select("vintage", F.col("pulled_at").alias("score_run_at")).distinct()
        runs = runs.join(done, ["vintage", "score_run_at"], "left_anti")
    return runs.withColumn("fiscal_code", fiscal.fiscal_code("vintage"))


def _usage_labels(month: bool = False) -> list[Column]:
    return [F.lower("platform").alias("platform"), renamed_region(F.col("region")).alias("region"), F.col("segment"),
            F.concat(F.lower("kind"), F.lit("_usage")).alias("sku"),
            (fiscal.month_date("year", "month") if month else F.col("date")).alias("date")]


def freeze_actuals(snapshots: DataFrame, pending: DataFrame) -> DataFrame:
    """Usage as known at each pending run, stamped with its vintage, for all runs in one join.

    Snapshots are summed first (map-side), then meet the few pending runs on the snapshot day.
    """
    known = snapshots.groupBy("snapshot_date", *_usage_labels()).agg(F.sum("dollars").cast(TOTAL).alias("dollars"))
    runs = pending.withColumn("snapshot_date", F.to_date("score_run_at"))
    joined = known.join(runs, "snapshot_date")
    return joined.select(
        F.lit(ACTUALS).alias("series"), F.lit(ACTUALS).alias("detail"), F.lit(ACTUALS).alias("display"), "vintage",
        "platform", "region", "segment", "sku", "date", F.lit(None).cast("double").alias("quantity"), "dollars",
        F.col("score_run_at").alias("pulled_at"), "fiscal_code")


def actuals_latest_frozen(frozen: DataFrame) -> DataFrame:
    newest = frozen.select(F.max("vintage")).scalar()
    return _silver(frozen.where(F.col("vintage") == newest), ACTUALS, ACTUALS, ACTUALS, vintage=_no_date())


def actuals_monthly(source: DataFrame) -> DataFrame:
    """Monthly actuals of one source, dated at month start."""
    sums = source.groupBy(*_usage_labels(month=True)).agg(F.sum("dollars").cast(TOTAL).alias("dollars"))
    return _silver(sums, ACTUALS, MONTHLY_ACTUALS, ACTUALS, vintage=_no_date())


def actuals_combined(daily: DataFrame, public: DataFrame, private: DataFrame) -> DataFrame:
    return daily.unionByName(public).unionByName(private)


# --- forecasts ---------------------------------------------------------------------------


def key_to_region_segment(rows: DataFrame) -> DataFrame:
    return rows.select("*", key_region(F.col("ts_key")).alias("region"), key_segment(F.col("ts_key")).alias("segment"))


def forecast_daily_active(forecast: DataFrame) -> DataFrame:
    """Active forecasts, averaged over the runs of a vintage."""
    means = forecast.where("is_active").groupBy("vintage", "ts_key", "date").agg(mean("y").alias("dollars"))
    return _silver(key_to_region_segment(means), AHEAD, "future forecast - daily", AHEAD,
                   platform=F.lit(C.NO_PLATFORM), sku=F.lit(C.NO_SKU))


def vintage_starts(daily: DataFrame) -> DataFrame:
    """Each vintage with its first forecast day and fiscal quarter."""
    return daily.groupBy("vintage").agg(F.min("date").alias("first_day")).select(
        "vintage", "first_day", fiscal.fiscal_code("vintage").alias("fiscal_code"))


def pad_actuals(daily: DataFrame, actuals: DataFrame) -> DataFrame:
    """For each vintage the actuals of its fiscal quarter before its first forecast day."""
    starts = vintage_starts(daily).select("vintage", "first_day", fiscal.fiscal_code("first_day").alias("fiscal_code"))
    dated = actuals.drop("vintage").withColumn("fiscal_code", fiscal.fiscal_code("date"))
    joined = dated.join(starts, "fiscal_code").where(F.col("date") < F.col("first_day"))
    return _silver(joined, AHEAD, "future forecast - padded actuals", AHEAD)


def monthly_vintage_asof(daily: DataFrame, monthly_forecast: DataFrame, date_from: Column | None = None) -> DataFrame:
    """Per daily vintage and unit, the newest monthly vintage of the same quarter not after it.

    ``date_from`` limits the target months before the newest vintage is picked; ties of rank
    one are all kept, they are the target months of one monthly vintage.
    """
    months = (key_to_region_segment(monthly_forecast.where("is_active").withColumnRenamed("vintage", "monthly_vintage"))
              .groupBy("monthly_vintage", "region", "segment", "date").agg(mean("y").alias("dollars"))
              .withColumn("fiscal_code", fiscal.fiscal_code("monthly_vintage"))
              .where(fiscal.fiscal_code("date") == F.col("fiscal_code")))
    joined = (vintage_starts(daily).join(months, "fiscal_code")
              .where(F.col("monthly_vintage") <= F.col("vintage")))
    if date_from is not None:
        joined = joined.where(F.col("date") >= date_from)
    newest_first = Window.partitionBy("vintage", "region", "segment").orderBy(F.desc("monthly_vintage"))
    picked = joined.withColumn("rank", F.rank().over(newest_first)).where("rank = 1")
    return _silver(picked, AHEAD, AHEAD_MONTHLY, AHEAD_MONTHLY, ("monthly_vintage",),
                   platform=F.lit(C.NO_PLATFORM), sku=F.lit(C.NO_SKU))


def monthly_actuals_repeated(daily: DataFrame, private: DataFrame, public: DataFrame) -> DataFrame:
    """Monthly actuals for every vintage of their quarter.

    Sums are taken per source segment; folding a region's segments to one label comes after,
    so a folded region keeps one row per source segment.
    """
    def labelled(actuals: DataFrame, name: str) -> DataFrame:
        sums = actuals.groupBy("region", F.col("segment").alias("source_segment"), "date").agg(
            F.sum("dollars").cast(WIDE).alias("dollars"))
        return sums.withColumn("detail", F.lit(f"future forecast - padded actuals {name}"))

    months = labelled(private, "private").unionByName(labelled(public, "public")).withColumn(
        "fiscal_code", fiscal.fiscal_code("date"))
    joined = months.join(vintage_starts(daily), "fiscal_code")
    segment = F.when(F.col("region").isin(*C.FOLDED_RENAMED), F.lit("All")).otherwise(F.col("source_segment"))
    return _silver(joined, AHEAD, F.col("detail"), AHEAD_MONTHLY, platform=F.lit(C.NO_PLATFORM),
                   segment=segment, sku=F.lit(C.NO_SKU))


SOURCE_PRIORITY = {AHEAD_MONTHLY: 1, "future forecast - padded actuals private": 2,
                   "future forecast - padded actuals public": 3}


def monthly_repeated(asof: DataFrame, repeated: DataFrame) -> DataFrame:
    """One source per vintage, unit and month: a forecast before private before public actuals."""
    priority = None
    for label, level in SOURCE_PRIORITY.items():
        hit = F.col("detail") == label
        priority = F.when(hit, level) if priority is None else priority.when(hit, level)
    best_first = Window.partitionBy("vintage", "platform", "region", "segment", "sku", "date").orderBy("priority")
    return (asof.select(*SILVER).unionByName(repeated).withColumn("priority", priority)
            .withColumn("rank", F.rank().over(best_first)).where("rank = 1").select(*SILVER))


# --- plans and first vintages ------------------------------------------------------------


def _plan_silver(plan: DataFrame, platform: Column, region: Column, segment: Column) -> DataFrame:
    label = F.concat(F.lit("plan - "), F.col("plan_kind"))
    return _silver(plan, label, label, label, vintage=F.to_date("as_of_date"),
                   platform=platform, region=region, segment=segment, sku=F.lit(None).cast("string"),
                   date=fiscal.month_date("year", "month"))


def plan_by_platform(plan: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    return _plan_silver(plan.where(F.lower("plan_kind") == "platform"), F.lower("platform"), none, none)


def plan_by_unit(plan: DataFrame) -> DataFrame:
    """Unit names split at the first blank; a name without one has no segment."""
    parts = F.split("platform", " ", 2)
    return _plan_silver(plan.where(F.lower("plan_kind") == "business unit"), F.lit(None).cast("string"),
                        renamed_region(F.get(parts, F.lit(0))), F.get(parts, F.lit(1)))


def first_vintage_by_quarter(vintages: DataFrame) -> DataFrame:
    """Earliest vintage of each fiscal quarter."""
    return vintages.groupBy(fiscal.fiscal_code("vintage").alias("fiscal_code")).agg(F.min("vintage").alias("first_vintage"))


def newest_quarter(first: DataFrame) -> DataFrame:
    """The row of the newest fiscal quarter only."""
    return first.where(F.col("fiscal_code") == first.select(F.max("fiscal_code")).scalar())


def plan_first_vintage(plan: DataFrame) -> DataFrame:
    """Per plan kind, the earliest plan date in its newest fiscal quarter."""
    dated = plan.select(F.lower("plan_kind").alias("plan_kind"), F.to_date("as_of_date").alias("vintage"))
    first = dated.groupBy("plan_kind", fiscal.fiscal_code("vintage").alias("fiscal_code")).agg(
        F.min("vintage").alias("first_vintage"))
    newest = F.max(F.struct("fiscal_code", "first_vintage")).alias("newest")
    return first.groupBy("plan_kind").agg(newest).select("plan_kind", "newest.fiscal_code", "newest.first_vintage")


def first_vintage_of(vintages: DataFrame, as_of: dt.date, vintage: str = "vintage") -> Column:
    """Earliest vintage in the fiscal quarter of ``as_of``, as a scalar."""
    same = fiscal.fiscal_code(vintage) == fiscal.fiscal_code(F.lit(as_of))
    return vintages.where(same).select(F.min(vintage)).scalar()
