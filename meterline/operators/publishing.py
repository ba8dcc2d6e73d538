"""Combining model outputs and publishing a vintage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import fiscal
from ..functions.keys import series_key
from ..functions.money import TOTAL, WIDE, mean

VALUES = ("y", "y_lower", "y_upper")


def _unquoted(c: str) -> Column:
    return F.replace(F.col(c), F.lit("'"), F.lit(""))


def standardise_model_output(raw: DataFrame, model: str) -> DataFrame:
    """Bring the output of one model into the common form of all models."""
    run_hour = F.date_trunc("hour", "run_at")
    return raw.select(
        F.concat(_unquoted("region"), _unquoted("segment"), F.lit(C.KEY_SUFFIX)).alias("ts_key"),
        F.lit(model).alias("model"), F.lit("na").alias("run_id"), F.to_date("ts").alias("date"),
        F.col("forecast").alias("y"), F.col("forecast_lower").alias("y_lower"), F.col("forecast_upper").alias("y_upper"),
        run_hour.alias("train_run_at"), F.lit("na").alias("train_run_uuid"), run_hour.alias("score_run_at"), "vintage",
        F.lit("na").alias("deployment_uuid"), F.lit(-1).alias("table_version"))


def ensemble_average(models: DataFrame) -> DataFrame:
    """Fold the carved-out series into its parent, then average the models."""
    carved = F.col("ts_key") == C.CARVE_OUT_KEY + C.KEY_SUFFIX
    key = F.when(carved, F.lit(C.CARVE_OUT_PARENT + C.KEY_SUFFIX)).otherwise(F.col("ts_key"))
    per_model = models.groupBy(key.alias("ts_key"), "date", "vintage", "model").agg(
        *[F.sum(v).cast(TOTAL).alias(v) for v in VALUES])
    return per_model.groupBy("ts_key", "date", "vintage").agg(*[mean(v).alias(v) for v in VALUES])


def replace_vintage(published: DataFrame, fresh: DataFrame) -> DataFrame:
    """Published rows with whole vintages swapped for fresh ones.

    A job writes ``fresh`` with a dynamic partition overwrite by vintage instead of
    rewriting the table; this is the same result as a DataFrame.
    """
    kept = published.join(fresh.select("vintage").distinct(), "vintage", "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


def monthly_promotion(raw: DataFrame, monthly: DataFrame) -> DataFrame:
    """Publish monthly model output: month-start dates, keys, vintage after the last actual month."""
    month = fiscal.month_date("year", "month")
    last = (monthly.groupBy(series_key(F.col("region"), F.col("segment")).alias("key"))
            .agg(F.add_months(F.max(month), 1).alias("vintage")))
    rows = raw.select(
        F.concat(_unquoted("region"), _unquoted("segment")).alias("key"), fiscal.month_start(F.to_date("ts")).alias("date"),
        F.to_date("run_at").alias("train_run_date"), F.to_date("run_at").alias("score_run_date"),
        F.col("forecast").alias("y"), F.col("forecast_lower").alias("y_lower"), F.col("forecast_upper").alias("y_upper"))
    return rows.join(last, "key").select(
        F.concat("key", F.lit(C.KEY_SUFFIX)).alias("ts_key"), "date", "train_run_date", "score_run_date", "vintage",
        *VALUES, F.lit(True).alias("is_active"))


def _key_sums(rows: DataFrame, key: Column) -> DataFrame:
    return rows.groupBy(key.alias("unit_key")).agg(*[F.sum(v).cast(WIDE).alias(v) for v in VALUES])


def _without_suffix(c: str) -> Column:
    return F.substring(F.col(c), F.lit(1), F.length(c) - len(C.KEY_SUFFIX))


def quarter_snapshot(forecast: DataFrame, models: DataFrame, snapshots: DataFrame, monthly: DataFrame,
                     monthly_forecast: DataFrame, own_model: str) -> DataFrame:
    """The running quarter of the newest vintage: actuals so far plus forecasts, per unit.

    Six parts: daily forecast, daily actuals, monthly actuals, monthly forecast, and forecast
    and actuals of the carved-out series. Every part is summed per key before the union.
    """
    newest = forecast.select(F.max("vintage")).scalar()
    start, end = fiscal.quarter_start(newest), fiscal.quarter_end(newest)
    closed = fiscal.last_closed_month(newest, C.CLOSE_DAY)
    monthly_vintage = fiscal.monthly_vintage_for(newest, C.CLOSE_DAY)
    ahead = (F.col("vintage") == newest) & F.col("date").between(newest, end)

    def as_actual(rows: DataFrame) -> DataFrame:
        return rows.select("*", *[F.col("dollars").alias(v) for v in VALUES])

    seen = as_actual(snapshots.where((F.col("snapshot_date") == newest) & (F.col("date") >= start) & (F.col("date") < newest)))
    carved = (F.col("segment") == C.CARVE_OUT_SEGMENT) & (F.col("sub_unit") == C.CARVE_OUT_SUB_UNIT)
    month = fiscal.month_date("year", "month")
    unit_key = series_key(F.col("region"), F.col("segment"))
    own = (F.col("model") == own_model) & (F.col("ts_key") == C.CARVE_OUT_KEY + C.KEY_SUFFIX)
    parts = [
        _key_sums(forecast.where(F.col("is_active") & ahead), _without_suffix("ts_key")),
        _key_sums(seen, unit_key),
        _key_sums(as_actual(monthly.where(month.between(start, closed))), unit_key),
        _key_sums(monthly_forecast.where(F.col("is_active") & (F.col("vintage") == monthly_vintage)
                                         & (F.col("date") > closed) & (F.col("date") <= end)), _without_suffix("ts_key")),
        _key_sums(models.where(own & ahead), _without_suffix("ts_key")),
        _key_sums(seen.where(carved), F.lit(C.CARVE_OUT_KEY)),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("unit_key").agg(
        F.sum("y").alias("forecast"), F.sum("y_lower").alias("forecast_lower"),
        F.sum("y_upper").alias("forecast_upper")).withColumn("vintage", newest)


BOUNDS = ("forecast_lower", "forecast", "forecast_upper")


def carve_out_residual(snapshot: DataFrame, names: DataFrame) -> DataFrame:
    """Take the carved-out series off its parent and give units their display names.

    The carved-out row is emitted twice, once as itself and once with a minus sign under its
    parent, so one small aggregation does the work of a self join.
    """
    def as_part(key: Column, sign: int) -> Column:
        return F.named_struct(F.lit("unit_key"), key, F.lit("own"), F.lit(sign > 0),
                              *[c for b in BOUNDS for c in (F.lit(b), (F.col(b) * sign).cast(WIDE))])

    itself = as_part(F.col("unit_key"), 1)
    parts = F.when(F.col("unit_key") == C.CARVE_OUT_KEY, F.array(itself, as_part(F.lit(C.CARVE_OUT_PARENT), -1))
                   ).otherwise(F.array(itself))
    rest = (snapshot.select("vintage", F.explode(parts).alias("p")).select("vintage", "p.*")
            .groupBy("unit_key", "vintage").agg(F.bool_or("own").alias("own"), *[F.sum(b).alias(b) for b in BOUNDS])
            .where("own"))
    return rest.join(names, "unit_key", "left").select("display_name", "position", "vintage", *BOUNDS)


def report_table(residual: DataFrame, vintage: Column | None = None) -> DataFrame:
    """One snapshot (the newest by default) rounded up to the next step, total row last.

    Rows and total come from one pass over grouping sets.
    """
    step = C.ROUND_UP_TO
    chosen = residual.select(F.max("vintage")).scalar() if vintage is None else vintage
    rows = residual.where(F.col("vintage") == chosen).select(
        "position", "display_name",
        *[(F.floor((F.col(b) + (step - 1)) / step) * step).cast("bigint").alias(b) for b in BOUNDS])
    keys = [F.col("position"), F.col("display_name")]
    is_total = F.grouping_id() > 0
    return (rows.withColumn("at", F.col("position")).groupingSets([keys, []], *keys)
            .agg(F.max("at").alias("at"), is_total.alias("total"), *[F.sum(b).alias(b) for b in BOUNDS])
            .select(F.when(F.col("total"), F.col("at") + 1).otherwise(F.col("position")).alias("position"),
                    F.when(F.col("total"), F.lit("Total")).otherwise(F.col("display_name")).alias("display_name"), *BOUNDS))


def current_fiscal_period(usage: DataFrame, date: Column) -> DataFrame:
    """Fiscal year and quarter of the latest loaded date, straight from the maximum."""
    newest = usage.agg(F.max(date).alias("date"))
    return newest.select("date", fiscal.fiscal_year("date").alias("fiscal_year"),
                         F.concat(F.lit("Q"), fiscal.fiscal_quarter("date").cast("string")).alias("fiscal_quarter"))
