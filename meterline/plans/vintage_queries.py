"""Queries on published forecasts, silver and gold tables (A4, A5, A6)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import config as C
from ..operators import gold as G
from ..operators import publishing as P
from ..operators import vintages as V
from ..sources import tables as T
from ..sources.shared import shared, stored
from . import inputs as I
from .oracle_inputs import LAST_VINTAGE, compose, fiscal_code, key, key_region, key_segment, month_start, quarter_end, quarter_start
from .oracle_silver import AS_OF, select_view
from .registry import query

#: Days before the newest vintage from which on vintages are published anew, and before which they are frozen already.
RERUN_DAYS, FROZEN_DAYS = 60, 90
_VALUES = "CAST(y AS DOUBLE) AS y, CAST(y_lower AS DOUBLE) AS y_lower, CAST(y_upper AS DOUBLE) AS y_upper"


# Tables that a query reads more than once are written first, as their own jobs do.


@shared
def published(spark, sf):
    return stored(I.unit_forecast(spark, sf))


@shared
def daily_forecast(spark, sf):
    return V.forecast_daily_active(published(spark, sf))


@shared
def frozen_actuals(spark, sf):
    return stored(V.freeze_actuals(I.usage_snapshots(spark, sf), V.new_vintages(published(spark, sf), None)))


@shared
def combined(spark, sf):
    """Actuals of all three sources, stored: both accuracy tables read them."""
    daily = V.actuals_latest_frozen(frozen_actuals(spark, sf))
    return stored(V.actuals_combined(daily, actuals_public(spark, sf), actuals_private(spark, sf)))


# --- A4 ----------------------------------------------------------------------------------


@query("standardise_model_output", compose(f"""
SELECT replace(region, '''', '') || replace(segment, '''', '') || '{C.KEY_SUFFIX}' AS ts_key, 'ridge' AS model, 'na' AS run_id,
 CAST(ts AS DATE) AS date, CAST(forecast AS DOUBLE) AS y, CAST(forecast_lower AS DOUBLE) AS y_lower,
 CAST(forecast_upper AS DOUBLE) AS y_upper, CAST(date_trunc('hour', run_at) AS TIMESTAMP) AS train_run_at, 'na' AS train_run_uuid,
 CAST(date_trunc('hour', run_at) AS TIMESTAMP) AS score_run_at, vintage, 'na' AS deployment_uuid, -1 AS table_version
FROM raw_model_output""", "raw_model_output"))
def standardise_model_output(spark, sf):
    return P.standardise_model_output(I.raw_model_output(spark, sf), "ridge")


@query("ensemble_average", compose(f"SELECT ts_key, date, vintage, {_VALUES} FROM ensemble", "ensemble"))
def ensemble_average(spark, sf):
    return P.ensemble_average(I.model_forecast(spark, sf))


@query("replace_vintage", compose(f"""
WITH fresh AS (
 SELECT ts_key, date, vintage, y, y_lower, y_upper, CAST(vintage AS TIMESTAMP) + INTERVAL 15 HOUR AS score_run_at, TRUE AS is_active
 FROM (SELECT CASE WHEN ts_key = '{C.CARVE_OUT_KEY}{C.KEY_SUFFIX}' THEN '{C.CARVE_OUT_PARENT}{C.KEY_SUFFIX}' ELSE ts_key END AS ts_key,
   date, vintage, sum(y) AS y, sum(y_lower) AS y_lower, sum(y_upper) AS y_upper
  FROM model_forecast WHERE model = 'naive7' AND vintage >= {LAST_VINTAGE} - {RERUN_DAYS} GROUP BY 1, 2, 3))
SELECT ts_key, date, vintage, {_VALUES}, score_run_at, is_active FROM unit_forecast
WHERE vintage NOT IN (SELECT vintage FROM fresh)
UNION ALL SELECT ts_key, date, vintage, {_VALUES}, score_run_at, is_active FROM fresh""", "model_forecast", "unit_forecast"))
def replace_vintage(spark, sf):
    rerun = I.model_forecast(spark, sf).where((F.col("model") == "naive7") & (F.col("vintage") >= F.lit(I.last_vintage(spark, sf) - dt.timedelta(days=RERUN_DAYS))))
    fresh = P.ensemble_average(rerun).select(
        "*", (F.col("vintage").cast("timestamp") + F.expr("interval 15 hours")).alias("score_run_at"), F.lit(True).alias("is_active"))
    return P.replace_vintage(I.unit_forecast(spark, sf), fresh)


_RAW_MONTHLY = f"""
SELECT '''' || regexp_replace(k, '({'|'.join(C.SEGMENTS)}|ALL)$', '') || '''' AS region,
 '''' || regexp_extract(k, '({'|'.join(C.SEGMENTS)}|ALL)$', 1) || '''' AS segment,
 CAST(last_day(date) AS TIMESTAMP) AS ts, y AS forecast, y_lower AS forecast_lower, y_upper AS forecast_upper, score_run_at AS run_at
FROM (SELECT *, substr(ts_key, 1, length(ts_key) - 1) AS k FROM unit_forecast_monthly)"""


@query("monthly_promotion", compose(f"""
SELECT k || '{C.KEY_SUFFIX}' AS ts_key, {month_start('ts')} AS date, CAST(run_at AS DATE) AS train_run_date,
 CAST(run_at AS DATE) AS score_run_date, v AS vintage, CAST(forecast AS DOUBLE) AS y, CAST(forecast_lower AS DOUBLE) AS y_lower,
 CAST(forecast_upper AS DOUBLE) AS y_upper, TRUE AS is_active
FROM (SELECT *, replace(region, '''', '') || replace(segment, '''', '') AS k FROM ({_RAW_MONTHLY})) r
JOIN (SELECT {key('region', 'segment')} AS u, CAST(max(make_date(year, month, 1)) + INTERVAL 1 MONTH AS DATE) AS v
      FROM monthly_usage GROUP BY 1) b ON r.k = b.u""", "unit_forecast_monthly", "monthly_usage"))
def monthly_promotion(spark, sf):
    pattern = f"({'|'.join(C.SEGMENTS)}|ALL){C.KEY_SUFFIX}$"
    quote = F.lit("'")
    raw = I.unit_forecast_monthly(spark, sf).select(
        F.concat(quote, F.regexp_replace("ts_key", pattern, ""), quote).alias("region"),
        F.concat(quote, F.regexp_extract("ts_key", pattern, 1), quote).alias("segment"),
        F.last_day("date").cast("timestamp").alias("ts"), F.col("y").alias("forecast"),
        F.col("y_lower").alias("forecast_lower"), F.col("y_upper").alias("forecast_upper"), F.col("score_run_at").alias("run_at"))
    return P.monthly_promotion(raw, I.monthly_usage(spark, sf))


_DOLLARS = ", ".join(["CAST(dollars AS DECIMAL(28,6))"] * 3)
_SIX = ", ".join(f"CAST({v} AS DECIMAL(28,6))" for v in P.VALUES)
_SNAPSHOT = f"""
WITH n AS (
 SELECT l, {quarter_start('l')} AS q_start, {quarter_end('l')} AS q_end,
  CAST(date_trunc('month', l) - CASE WHEN day(l) <= {C.CLOSE_DAY} THEN INTERVAL 2 MONTH ELSE INTERVAL 1 MONTH END AS DATE) AS closed
 FROM (SELECT max(vintage) AS l FROM unit_forecast)),
seen AS (SELECT s.* FROM usage_snapshots s, n WHERE snapshot_date = l AND date >= q_start AND date < l),
parts AS (
 SELECT substr(ts_key, 1, length(ts_key) - 1) AS unit_key, y, y_lower, y_upper FROM unit_forecast, n
 WHERE is_active AND vintage = l AND date BETWEEN l AND q_end
 UNION ALL SELECT {key('region', 'segment')}, {_DOLLARS} FROM seen
 UNION ALL SELECT {key('region', 'segment')}, {_DOLLARS} FROM monthly_usage, n
  WHERE make_date(year, month, 1) BETWEEN q_start AND closed
 UNION ALL SELECT substr(ts_key, 1, length(ts_key) - 1), {_SIX} FROM unit_forecast_monthly, n
  WHERE is_active AND vintage = closed + INTERVAL 1 MONTH AND date > closed AND date <= q_end
 UNION ALL SELECT substr(ts_key, 1, length(ts_key) - 1), {_SIX} FROM model_forecast, n
  WHERE model = 'naive7' AND ts_key = '{C.CARVE_OUT_KEY}{C.KEY_SUFFIX}' AND vintage = l AND date BETWEEN l AND q_end
 UNION ALL SELECT '{C.CARVE_OUT_KEY}', {_DOLLARS} FROM seen
  WHERE segment = '{C.CARVE_OUT_SEGMENT}' AND sub_unit = '{C.CARVE_OUT_SUB_UNIT}'),
snapshot AS (
 SELECT unit_key, sum(y) AS forecast, sum(y_lower) AS forecast_lower, sum(y_upper) AS forecast_upper, any_value(l) AS vintage
 FROM parts, n GROUP BY unit_key),
names AS (SELECT * FROM (VALUES {', '.join(f"('{k}', '{n}', {i})" for i, (k, n) in enumerate(C.UNIT_ORDER, 1))}) t(unit_key, display_name, position)),
residual AS (
 SELECT display_name, position, a.vintage,
  {', '.join(f"a.{b} - CASE WHEN a.unit_key = '{C.CARVE_OUT_PARENT}' THEN coalesce(c.{b}, 0) ELSE 0 END AS {b}" for b in P.BOUNDS)}
 FROM snapshot a LEFT JOIN names ON names.unit_key = a.unit_key
 LEFT JOIN (SELECT * FROM snapshot WHERE unit_key = '{C.CARVE_OUT_KEY}') c ON c.vintage = a.vintage)
"""
_BOUNDS = ", ".join(f"CAST({b} AS DOUBLE) AS {b}" for b in P.BOUNDS)
_SNAPSHOT_VIEWS = ("unit_forecast", "usage_snapshots", "monthly_usage", "unit_forecast_monthly", "model_forecast")


@query("quarter_snapshot", compose(f"{_SNAPSHOT} SELECT unit_key, {_BOUNDS}, vintage FROM snapshot", *_SNAPSHOT_VIEWS))
def quarter_snapshot(spark, sf):
    return P.quarter_snapshot(published(spark, sf), I.model_forecast(spark, sf), I.usage_snapshots(spark, sf),
                              I.monthly_usage(spark, sf), I.unit_forecast_monthly(spark, sf), "naive7")


def _names(spark):
    rows = [(k, n, i) for i, (k, n) in enumerate(C.UNIT_ORDER, 1)]
    return T.rule_table(spark, rows, "unit_key string, display_name string, position int")


@query("carve_out_residual", compose(f"{_SNAPSHOT} SELECT display_name, position, vintage, {_BOUNDS} FROM residual", *_SNAPSHOT_VIEWS))
def carve_out_residual(spark, sf):
    return P.carve_out_residual(quarter_snapshot(spark, sf), _names(spark))


_STEP = C.ROUND_UP_TO
_ROUNDED = ", ".join(f"CAST(floor(({b} + {_STEP - 1}) / {_STEP}) * {_STEP} AS BIGINT) AS {b}" for b in P.BOUNDS)


@query("report_table", compose(f"""{_SNAPSHOT},
r AS (SELECT position, display_name, {_ROUNDED} FROM residual WHERE vintage = (SELECT max(vintage) FROM residual))
SELECT * FROM r UNION ALL
SELECT CAST(max(position) + 1 AS INTEGER), 'Total', {', '.join(f'CAST(sum({b}) AS BIGINT)' for b in P.BOUNDS)} FROM r""", *_SNAPSHOT_VIEWS))
def report_table(spark, sf):
    newest = published(spark, sf).select(F.max("vintage")).scalar()
    return P.report_table(carve_out_residual(spark, sf), newest)


@query("current_fiscal_period", f"""
SELECT DISTINCT CAST(l_shipdate AS DATE) AS date, CAST(year(l_shipdate + INTERVAL 11 MONTH) AS INTEGER) AS fiscal_year,
 'Q' || quarter(l_shipdate + INTERVAL 11 MONTH) AS fiscal_quarter FROM lineitem WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem)""")
def current_fiscal_period(spark, sf):
    return P.current_fiscal_period(T.read(spark, sf, "lineitem"), F.to_date("l_shipdate"))


# --- A5 ----------------------------------------------------------------------------------


@query("new_vintages", compose(f"""
SELECT vintage, score_run_at, {fiscal_code('vintage')} AS fiscal_code FROM runs WHERE vintage >= {LAST_VINTAGE} - {FROZEN_DAYS}""", "runs"))
def new_vintages(spark, sf):
    forecast = published(spark, sf)
    done = forecast.where(F.col("vintage") < F.lit(I.last_vintage(spark, sf) - dt.timedelta(days=FROZEN_DAYS))).withColumnRenamed("score_run_at", "pulled_at")
    return V.new_vintages(forecast, done)


@query("freeze_actuals", compose(select_view("frozen"), "frozen"))
def freeze_actuals(spark, sf):
    return V.freeze_actuals(I.usage_snapshots(spark, sf), V.new_vintages(I.unit_forecast(spark, sf), None))


@query("actuals_latest_frozen", compose(select_view("actuals_daily"), "actuals_daily"))
def actuals_latest_frozen(spark, sf):
    return V.actuals_latest_frozen(frozen_actuals(spark, sf))


@query("actuals_public", compose(select_view("actuals_public"), "actuals_public"))
def actuals_public(spark, sf):
    return V.actuals_monthly(T.monthly_public(spark, sf))


@query("actuals_private", compose(select_view("actuals_private"), "actuals_private"))
def actuals_private(spark, sf):
    return V.actuals_monthly(T.monthly_private(spark, sf))


@query("actuals_combined", compose(select_view("actuals_combined"), "actuals_combined"))
def actuals_combined(spark, sf):
    return V.actuals_combined(actuals_latest_frozen(spark, sf), actuals_public(spark, sf), actuals_private(spark, sf))


@query("key_to_region_segment", compose(f"""
SELECT ts_key, count(*) AS forecast_rows, {key_region('ts_key')} AS region, {key_segment('ts_key')} AS segment
FROM model_forecast GROUP BY ts_key""", "model_forecast"))
def key_to_region_segment(spark, sf):
    return V.key_to_region_segment(I.model_forecast(spark, sf).groupBy("ts_key").agg(F.count("*").alias("forecast_rows")))


@query("forecast_daily_active", compose(select_view("forecast_daily"), "forecast_daily"))
def forecast_daily_active(spark, sf):
    return V.forecast_daily_active(I.unit_forecast(spark, sf))


@query("pad_actuals", compose(select_view("padded"), "padded"))
def pad_actuals(spark, sf):
    return V.pad_actuals(daily_forecast(spark, sf), actuals_latest_frozen(spark, sf))


_LABELLED = (f"'future forecast' AS series, {{detail}} AS detail, 'future forecast - monthly' AS display, vintage, "
             f"'{C.NO_PLATFORM}' AS platform, region, segment, '{C.NO_SKU}' AS sku, date, CAST(NULL AS DOUBLE) AS quantity, "
             "CAST(dollars AS DOUBLE) AS dollars")


@query("monthly_vintage_asof", compose(
    f"SELECT {_LABELLED.format(detail=chr(39) + V.AHEAD_MONTHLY + chr(39))}, monthly_vintage FROM monthly_asof", "monthly_asof"))
def monthly_vintage_asof(spark, sf):
    return V.monthly_vintage_asof(daily_forecast(spark, sf), I.unit_forecast_monthly(spark, sf))


@query("monthly_actuals_repeated", compose(
    f"SELECT {_LABELLED.format(detail='detail')} FROM monthly_actuals_repeated", "monthly_actuals_repeated"))
def monthly_actuals_repeated(spark, sf):
    return V.monthly_actuals_repeated(daily_forecast(spark, sf), actuals_private(spark, sf), actuals_public(spark, sf))


@query("monthly_repeated", compose(select_view("monthly_repeated"), "monthly_repeated"))
def monthly_repeated(spark, sf):
    return V.monthly_repeated(monthly_vintage_asof(spark, sf), monthly_actuals_repeated(spark, sf))


@query("plan_by_platform", compose(select_view("plan_platform"), "plan_platform"))
def plan_by_platform(spark, sf):
    return V.plan_by_platform(I.plan(spark, sf))


@query("plan_by_unit", compose(select_view("plan_unit"), "plan_unit"))
def plan_by_unit(spark, sf):
    return V.plan_by_unit(I.plan(spark, sf))


@query("plan_first_vintage", compose("SELECT plan_kind, fiscal_code, first_vintage FROM plan_first", "plan_first"))
def plan_first_vintage(spark, sf):
    return V.plan_first_vintage(I.plan(spark, sf))


@query("model_first_vintage_by_quarter", compose("SELECT fiscal_code, first_vintage FROM model_first", "model_first"))
def model_first_vintage_by_quarter(spark, sf):
    return V.first_vintage_by_quarter(I.unit_forecast(spark, sf).where("is_active"))


@query("model_first_vintage_current", compose(
    "SELECT fiscal_code, first_vintage FROM model_first WHERE fiscal_code = (SELECT max(fiscal_code) FROM model_first)", "model_first"))
def model_first_vintage_current(spark, sf):
    return V.newest_quarter(V.first_vintage_by_quarter(daily_forecast(spark, sf)))


# --- A6 ----------------------------------------------------------------------------------


@query("tall_table", compose(select_view("tall"), "tall"))
def tall_table(spark, sf):
    parts = (actuals_combined, monthly_repeated, daily_forecast, pad_actuals, plan_by_platform, plan_by_unit)
    return G.tall_table([build(spark, sf) for build in parts])


_ACCURACY_DOUBLES = ("SELECT * REPLACE (CAST(plan_dollars AS DOUBLE) AS plan_dollars, CAST(actual_dollars AS DOUBLE) AS actual_dollars, "
                     "CAST(model_dollars AS DOUBLE) AS model_dollars) FROM {}")


@query("accuracy_by_platform", compose(_ACCURACY_DOUBLES.format("accuracy_platform"), "accuracy_platform"))
def accuracy_by_platform(spark, sf):
    return G.accuracy_by_platform(combined(spark, sf), plan_by_platform(spark, sf), plan_first_vintage(spark, sf))


@query("accuracy_by_unit", compose(_ACCURACY_DOUBLES.format("accuracy_unit"), "accuracy_unit"))
def accuracy_by_unit(spark, sf):
    return G.accuracy_by_unit(combined(spark, sf), plan_by_unit(spark, sf), plan_first_vintage(spark, sf),
                              daily_forecast(spark, sf), I.unit_forecast_monthly(spark, sf), I.report_day(spark, sf))


@query("quarter_to_date_accuracy", compose(_ACCURACY_DOUBLES.format("accuracy"), "accuracy"))
def quarter_to_date_accuracy(spark, sf):
    return G.quarter_to_date_accuracy(accuracy_by_platform(spark, sf), accuracy_by_unit(spark, sf), I.report_day(spark, sf))


@query("monthly_first_vintage_in_quarter", compose(
    f"SELECT ts_key, date, vintage, {_VALUES} FROM monthly_first", "monthly_first"))
def monthly_first_vintage_in_quarter(spark, sf):
    return G.monthly_first_vintage_in_quarter(I.unit_forecast_monthly(spark, sf), I.report_day(spark, sf))


@query("total_quarter_by_vintage", compose(select_view("quarter_totals"), "quarter_totals"))
def total_quarter_by_vintage(spark, sf):
    monthly = actuals_private(spark, sf).unionByName(actuals_public(spark, sf))
    return G.total_quarter_by_vintage(frozen_actuals(spark, sf), monthly, daily_forecast(spark, sf),
                                      I.unit_forecast_monthly(spark, sf), I.report_day(spark, sf))


_OVERLAP = "SELECT string_agg(strftime(date, '%B %Y'), ', ' ORDER BY date) AS overlap_months FROM (SELECT DISTINCT date FROM accuracy)"


@query("overlap_months", compose(_OVERLAP, "accuracy"))
def overlap_months(spark, sf):
    return G.overlap_months(quarter_to_date_accuracy(spark, sf))


def _first_in_quarter(column: str, table: str) -> str:
    return f"(SELECT min(CAST({column} AS DATE)) FROM {table} WHERE {fiscal_code(column)} = {fiscal_code(AS_OF)})"


@query("dashboard_metadata", compose(f"""
SELECT CAST({AS_OF} AS TIMESTAMP) AS refreshed_at,
 (SELECT max(vintage) FROM forecast_daily) AS latest_daily_vintage,
 (SELECT max(vintage) FROM unit_forecast_monthly) AS latest_monthly_vintage,
 {_first_in_quarter('vintage', 'forecast_daily')} AS first_daily_vintage_in_quarter,
 {_first_in_quarter('as_of_date', 'plan')} AS first_plan_date_in_quarter,
 ({_OVERLAP}) AS overlap_months, strftime({AS_OF}, '%B %Y') AS current_month,
 CAST(date_trunc('week', {AS_OF}) + INTERVAL 7 DAY AS DATE) AS next_refresh_date,
 (SELECT CAST(max(date) + INTERVAL 1 MONTH + INTERVAL {C.CLOSE_LAG_DAYS} DAY AS DATE) FROM accuracy) AS accuracy_refresh_date""",
    "forecast_daily", "unit_forecast_monthly", "plan", "accuracy"))
def dashboard_metadata(spark, sf):
    return G.dashboard_metadata(daily_forecast(spark, sf), I.unit_forecast_monthly(spark, sf), I.plan(spark, sf),
                                quarter_to_date_accuracy(spark, sf), I.report_day(spark, sf))
