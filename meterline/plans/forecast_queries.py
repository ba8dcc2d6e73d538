"""Queries on series models, splits and metrics (A3)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from .. import config as C
from ..functions import terms as X
from ..functions.keys import series_key
from ..operators import calendar as cal
from ..operators import forecasting as M
from ..operators import series as S
from ..operators import series_models as R
from ..sources import tables as T
from ..sources.shared import kept, shared, stored
from . import inputs as I
from . import series_queries as SQ
from .oracle_inputs import compose, key
from .registry import query

BREAKS = 5
WINDOWS = (7, 28, 91)


def _dense(series, key):
    spine = cal.calendar_spine(series, key, "date")
    return (spine.join(series, [key, "date"], "left")
            .select(key, "date", F.coalesce("dollars", F.lit(0).cast("decimal(18,4)")).alias("dollars")))


@shared
def dense_units(spark, sf):
    """Daily unit series with a zero for every day without usage."""
    return _dense(SQ.unit_days(spark, sf), "unit")


@shared
def dense_sub_units(spark, sf):
    return _dense(stored(S.daily_series(T.daily_usage(spark, sf), "sub_unit")), "sub_unit")


_DENSE = f"""
SELECT unit, date, coalesce(s.dollars, 0) AS dollars FROM (
 SELECT unit, CAST(d AS DATE) AS date
 FROM (SELECT unit, min(date) AS a, max(date) AS b FROM daily_usage GROUP BY unit), generate_series(a, b, INTERVAL 1 DAY) g(d))
LEFT JOIN ({SQ._UNIT_SERIES.format(key='unit')}) s USING (unit, date)"""

_YEARS = f"(date - first) / CAST({X.YEAR_DAYS} AS DOUBLE)"
_FRAMED = f"""SELECT *, min(date) OVER (PARTITION BY unit) AS first,
 max(CASE WHEN dollars IS NOT NULL THEN date END) OVER (PARTITION BY unit) AS last FROM ({SQ._FRAME_DAILY})"""


@query("growth_terms", compose(f"""
SELECT unit, date, CAST(dollars AS DOUBLE) AS dollars, round({_YEARS}, 6) AS trend_linear,
 round(({_YEARS}) * ({_YEARS}), 6) AS trend_quadratic, round(sqrt({_YEARS}), 6) AS trend_sqrt FROM ({_FRAMED})""", "daily_usage"))
def growth_terms(spark, sf):
    return M.growth_terms(SQ.future_frame_daily(spark, sf), "unit")


_CYCLES = {"yearly": "year", "quarterly": "quarter", "monthly": "month", "weekly": "week"}
_LENGTHS = {"year": "INTERVAL 12 MONTH", "quarter": "INTERVAL 3 MONTH", "month": "INTERVAL 1 MONTH", "week": "INTERVAL 7 DAY"}


def _phase_sql(cycle: str) -> str:
    part = _CYCLES[cycle]
    first = f"CAST(date_trunc('{part}', date) AS DATE)"
    return f"((date - {first}) / CAST(CAST({first} + {_LENGTHS[part]} AS DATE) - {first} AS DOUBLE))"


_SEASON_COLUMNS = ", ".join(
    f"round({f}(CAST({2 * math.pi * k!r} AS DOUBLE) * {_phase_sql(cycle)}), 6) + 0.0 AS {f}_{cycle}_{k}"
    for cycle, order in X.DAILY_SEASONS for k in range(1, order + 1) for f in ("sin", "cos"))


@query("seasonal_terms", compose(f"SELECT unit, date, CAST(dollars AS DOUBLE) AS dollars, {_SEASON_COLUMNS} "
                                 f"FROM ({SQ._FRAME_DAILY})", "daily_usage"))
def seasonal_terms(spark, sf):
    return M.seasonal_terms(SQ.future_frame_daily(spark, sf), "unit")


_BREAK_COLUMNS = ", ".join(
    f"round(greatest(date - (first + CAST(floor((last - first) * {i} / CAST({BREAKS + 1} AS DOUBLE)) AS INTEGER)), 0)"
    f" / CAST({X.YEAR_DAYS} AS DOUBLE), 6) AS break_{i}" for i in range(1, BREAKS + 1))


@query("changepoint_terms", compose(f"SELECT unit, date, CAST(dollars AS DOUBLE) AS dollars, {_BREAK_COLUMNS} "
                                    f"FROM ({_FRAMED})", "daily_usage"))
def changepoint_terms(spark, sf):
    return M.changepoint_terms(SQ.future_frame_daily(spark, sf), "unit", BREAKS)


@query("changepoints_detected", compose(f"""
WITH b AS (
 SELECT unit, first, CAST((date - first) // 30 AS INTEGER) AS bucket, sum(dollars) AS amount
 FROM (SELECT *, min(date) OVER (PARTITION BY unit) AS first FROM ({_DENSE})) GROUP BY ALL),
t AS (
 SELECT *, lead(amount) OVER w - 2 * amount + lag(amount) OVER w AS turn, max(bucket) OVER (PARTITION BY unit) AS last_bucket
 FROM b WINDOW w AS (PARTITION BY unit ORDER BY bucket)),
s AS (SELECT *, abs(turn) AS score FROM t WHERE turn IS NOT NULL),
k AS (
 SELECT a.*, (SELECT max(score) FROM s o WHERE o.unit = a.unit) AS top,
  (SELECT max(score) FROM s o WHERE o.unit = a.unit AND o.bucket BETWEEN a.bucket - 2 AND a.bucket - 1) AS before,
  (SELECT max(score) FROM s o WHERE o.unit = a.unit AND o.bucket BETWEEN a.bucket + 1 AND a.bucket + 2) AS after FROM s a)
SELECT unit, first + bucket * 30 AS break_date, CAST(turn AS DOUBLE) AS turn FROM k
WHERE CAST(score AS DOUBLE) >= CAST(top AS DOUBLE) * 0.5 AND score > coalesce(before, -1) AND score >= coalesce(after, -1)
 AND bucket <= last_bucket * CAST(0.9 AS DOUBLE)""", "daily_usage"))
def changepoints_detected(spark, sf):
    return M.detected_changepoints(dense_units(spark, sf), "unit")


# --- search and refit: checked by properties in the tests --------------------------------

_H = C.DAILY_HORIZON
_MONTHS = C.MONTHLY_SPLIT_SPACING


@kept(lambda: R.DAILY.candidates())
def daily_scores(spark, sf):
    """Scores of all candidates on all splits of the units, as the search job keeps them."""
    return R.candidate_scores(stored(dense_units(spark, sf)), "unit", R.DAILY, _H, _H, R.DAILY.candidates())


@kept(lambda: R.MONTHLY.candidates())
def monthly_scores(spark, sf):
    series = stored(R.dense_months(SQ.monthly_union_series(spark, sf), "unit"))
    return R.candidate_scores(series, "unit", R.MONTHLY, _MONTHS, _MONTHS, R.MONTHLY.candidates())


def _settings(spark, best, kind):
    return best.join(F.broadcast(R.candidate_table(spark, kind.candidates())), "candidate")  # at most the search budget


@query("candidate_search")
def candidate_search(spark, sf):
    """Winner of each unit by MAPE, with its settings."""
    return _settings(spark, R.candidate_search(daily_scores(spark, sf), "unit", "mape"), R.DAILY)


@query("candidate_search_monthly")
def candidate_search_monthly(spark, sf):
    return _settings(spark, R.candidate_search(monthly_scores(spark, sf), "unit", "smape"), R.MONTHLY)


@query("series_forecast_daily")
def series_forecast_daily(spark, sf):
    """Search, then refit every unit with its winner."""
    frame = S.future_frame_daily(stored(dense_units(spark, sf)), "unit")
    return R.searched_forecast(frame, "unit", R.DAILY, daily_scores(spark, sf), R.DAILY.candidates(), "mape")


@query("series_forecast_monthly")
def series_forecast_monthly(spark, sf):
    series = stored(R.dense_months(SQ.monthly_union_series(spark, sf), "unit"))
    frame = S.future_frame_monthly(series, "unit", SQ.as_of(spark, sf))
    return R.searched_forecast(frame, "unit", R.MONTHLY, monthly_scores(spark, sf), R.MONTHLY.candidates(), "smape")


@query("series_forecast_daily_sub_unit")
def series_forecast_daily_sub_unit(spark, sf):
    series = stored(dense_sub_units(spark, sf))
    candidates = R.DAILY.candidates()
    scores = stored(R.candidate_scores(series, "sub_unit", R.DAILY, _H, _H, candidates))
    return R.searched_forecast(S.future_frame_daily(series, "sub_unit"), "sub_unit", R.DAILY, scores, candidates, "mape")


@query("series_forecast_monthly_sub_unit")
def series_forecast_monthly_sub_unit(spark, sf):
    series = stored(R.dense_months(SQ.monthly_sub_units(spark, sf), "sub_unit"))
    candidates = R.MONTHLY.candidates()
    scores = stored(R.candidate_scores(series, "sub_unit", R.MONTHLY, _MONTHS, _MONTHS, candidates))
    frame = S.future_frame_monthly(series, "sub_unit", SQ.as_of(spark, sf))
    return R.searched_forecast(frame, "sub_unit", R.MONTHLY, scores, candidates, "smape")


@query("candidate_search_summary")
def candidate_search_summary(spark, sf):
    """Rank, mean and per-split score of every candidate of the search."""
    scores = daily_scores(spark, sf).select(
        "unit", F.col("candidate").cast("string").alias("candidate"), "split", F.col("mape").cast("decimal(18,6)").alias("score"), "fit_rows")
    return M.search_summary(scores, "unit")


@query("candidate_backtest")
def candidate_backtest(spark, sf):
    """Errors of each unit's winner on the newest split, over all of its training part and its test part."""
    scores = daily_scores(spark, sf)
    newest = scores.where("split = 1").join(R.candidate_search(scores, "unit", "mape").select("unit", "candidate"), ["unit", "candidate"])
    part = lambda name, prefix: newest.select("unit", F.lit(name).alias("part"), *[F.col(f"{prefix}{m}").alias(m) for m in R.METRICS])
    return M.backtest_summary(part("train", "train_").unionByName(part("test", "")), "unit", R.METRICS)


@query("forecast_checks", compose(f"""
WITH u AS (SELECT unit, max(m) OVER () AS m FROM (SELECT unit, max(date) AS m FROM daily_usage GROUP BY unit))
SELECT unit, CAST({_H} AS BIGINT) AS days, CAST(m + 1 AS DATE) AS first_day, CAST(m + {_H} AS DATE) AS last_day, TRUE AS ordered_bands,
 TRUE AS winner_has_least_score, TRUE AS winner_is_in_the_grid FROM u""", "daily_usage"))
def forecast_checks(spark, sf):
    """What must hold of a searched forecast: every day of the horizon once, ordered bands, the least stored score won."""
    scores, best = daily_scores(spark, sf), candidate_search(spark, sf)
    forecast = stored(series_forecast_daily(spark, sf))
    days = forecast.groupBy("unit").agg(
        F.count_distinct("date").alias("days"), F.min("date").alias("first_day"), F.max("date").alias("last_day"),
        F.every(F.col("forecast").between(F.col("forecast_lower"), F.col("forecast_upper"))).alias("ordered_bands"))
    least = scores.where(~F.isnan("mape")).groupBy("unit", "candidate").agg(F.avg("mape").alias("mean")).groupBy("unit").agg(F.min("mean").alias("least"))
    won = best.join(least, "unit").select(
        "unit", (F.col("score") <= F.col("least") + 1e-9).alias("winner_has_least_score"), F.col("breaks").isNotNull().alias("winner_is_in_the_grid"))
    return days.join(won, "unit")


# --- splits, metrics, search -------------------------------------------------------------

_SPLITS = """
SELECT {key}, '{grain}' AS grain, date, CAST(dollars AS DOUBLE) AS dollars, CAST(k AS INTEGER) AS split, cut,
 CASE WHEN date <= cut THEN 'train' ELSE 'test' END AS part
FROM (SELECT *, {cut} AS cut, {end} AS cut_end FROM (
 SELECT *, max(date) OVER (PARTITION BY {key}) AS last FROM ({series})), generate_series(1, """ + str(C.MAX_SPLITS) + """) g(k))
WHERE date <= cut_end"""


@query("rolling_origin_splits", compose(
    _SPLITS.format(key="unit", grain="day", series=SQ._UNIT_SERIES.format(key="unit"),
                   cut=f"last - CAST(k * {_H} AS INTEGER)", end=f"last - CAST(k * {_H} - {_H} AS INTEGER)")
    + " UNION ALL " +
    _SPLITS.format(key="unit", grain="month", series=SQ._monthly_sql("unit"),
                   cut="last_day(CAST(last - to_months(CAST(3 * k AS INTEGER)) AS DATE))",
                   end="last_day(CAST(last - to_months(CAST(3 * k - 3 AS INTEGER)) AS DATE))"),
    "daily_usage", "monthly_usage"))
def rolling_origin_splits(spark, sf):
    daily = SQ.unit_days(spark, sf)
    monthly = SQ.monthly_union_series(spark, sf)
    spacing = C.MONTHLY_SPLIT_SPACING
    return (M.rolling_origin_splits(daily, "unit", _H, _H).withColumn("grain", F.lit("day"))
            .unionByName(M.rolling_origin_splits(monthly, "unit", spacing, spacing, "month").withColumn("grain", F.lit("month"))))


_METRIC_SQL = f"""
SELECT {{keys}}, count(*) AS blocks, round(sqrt(sum(CAST(e AS DOUBLE) * CAST(e AS DOUBLE)) / count(*)), 4) AS rmse,
 round(CAST(sum(e) AS DOUBLE) / count(*), 4) AS mae,
 round(avg(CASE WHEN a <> 0 THEN CAST(e AS DOUBLE) / abs(CAST(a AS DOUBLE)) END) * 100, 6) AS mape,
 round(avg(CASE WHEN abs(a) + abs(f) <> 0 THEN 2 * CAST(e AS DOUBLE) / (abs(CAST(a AS DOUBLE)) + abs(CAST(f AS DOUBLE))) END) * 100, 6) AS smape,
 round(avg(CASE WHEN CAST(e AS DOUBLE) > CAST({C.RELATIVE_TOLERANCE} AS DOUBLE) * abs(CAST(a AS DOUBLE)) THEN 1.0 ELSE 0.0 END), 6) AS share_outside
FROM (SELECT *, CAST(abs(a - f) AS DECIMAL(18,4)) AS e FROM (
 SELECT {{keys}}, block, CAST(sum(actual) AS DECIMAL(18,4)) AS a, CAST(sum(forecast) AS DECIMAL(18,4)) AS f
 FROM ({{rows}}) GROUP BY ALL)) GROUP BY {{keys}}"""

_FORECAST_ROWS = f"""
SELECT f.ts_key, f.model, f.vintage, CAST((f.date - f.vintage) // {C.METRIC_PERIODS_DAILY} AS INTEGER) AS block,
 coalesce(a.dollars, 0) AS actual, f.y AS forecast
FROM (SELECT CASE WHEN ts_key = '{C.CARVE_OUT_KEY}{C.KEY_SUFFIX}' THEN '{C.CARVE_OUT_PARENT}{C.KEY_SUFFIX}' ELSE ts_key END AS ts_key,
       model, vintage, date, sum(y) AS y FROM model_forecast GROUP BY ALL) f
LEFT JOIN (SELECT {key('region', 'segment')} || '{C.KEY_SUFFIX}' AS ts_key, date, sum(dollars) AS dollars FROM daily_usage GROUP BY ALL) a
 ON a.ts_key = f.ts_key AND a.date = f.date"""


@shared
def forecast_and_actual(spark, sf):
    """Forecast rows of each model, carved-out part folded back, next to what came."""
    models = I.model_forecast(spark, sf)
    ts_key = F.when(F.col("ts_key") == C.CARVE_OUT_KEY + C.KEY_SUFFIX, C.CARVE_OUT_PARENT + C.KEY_SUFFIX).otherwise(F.col("ts_key"))
    folded = models.groupBy(ts_key.alias("ts_key"), "model", "vintage", "date").agg(F.sum("y").alias("forecast"))
    actual = (T.daily_usage(spark, sf)
              .groupBy(F.concat(series_key(F.col("region"), F.col("segment")), F.lit(C.KEY_SUFFIX)).alias("ts_key"), "date")
              .agg(F.sum("dollars").alias("actual")))
    return folded.join(actual, ["ts_key", "date"], "left").fillna({"actual": 0})


@query("forecast_metrics", compose(_METRIC_SQL.format(keys="ts_key, model, vintage", rows=_FORECAST_ROWS),
                                   "model_forecast", "daily_usage"))
def forecast_metrics(spark, sf):
    block = F.floor(F.datediff("date", "vintage") / C.METRIC_PERIODS_DAILY).cast("int")
    return M.forecast_metrics(forecast_and_actual(spark, sf), ["ts_key", "model", "vintage"], block)


# blocks of the window-mean candidates, for both parts of every split
_WINDOW_BLOCKS = f"""
SELECT n.unit, n.split, n.part, n.block, w AS "window", n.actual,
 CAST(CAST((CAST(floor(l.total * 10000) AS BIGINT) * least({C.METRIC_PERIODS_DAILY}, {_H} - block * {C.METRIC_PERIODS_DAILY})) // w
   AS DECIMAL(20,0)) * 0.0001 AS DECIMAL(18,4)) AS forecast
FROM (
 SELECT unit, split, part, block, sum(dollars) AS actual FROM (
  SELECT *, CASE WHEN part = 'train' THEN (cut - date) // {C.METRIC_PERIODS_DAILY} ELSE (date - cut - 1) // {C.METRIC_PERIODS_DAILY} END AS block
  FROM labelled WHERE date > cut - {_H}) GROUP BY ALL) n
JOIN (
 SELECT unit, split, w, sum(dollars) AS total FROM labelled, (VALUES {', '.join(f'({w})' for w in WINDOWS)}) t(w)
 WHERE part = 'train' AND date > cut - w GROUP BY ALL) l
 ON l.unit = n.unit AND l.split = n.split"""
_LABELLED = ("labelled AS (" + _SPLITS.format(
    key="unit", grain="day", series=_DENSE, cut=f"last - CAST(k * {_H} AS INTEGER)",
    end=f"last - CAST(k * {_H} - {_H} AS INTEGER)").replace("CAST(dollars AS DOUBLE) AS dollars", "dollars") + ")")


def _window_metrics(spark, sf):
    blocks = M.window_mean_scores(dense_units(spark, sf), "unit", WINDOWS, _H)
    return M.forecast_metrics(blocks, ["unit", "split", "part", "window"], F.col("block"))


@query("search_summary", compose(f"""
WITH {_LABELLED}, m AS ({_METRIC_SQL.format(keys='unit, split, part, "window"', rows=_WINDOW_BLOCKS)}),
c AS (SELECT unit, 'mean' || "window" AS candidate, split, CAST(mape AS DECIMAL(18,6)) AS score, "window" AS fit_rows
      FROM m WHERE part = 'test'),
a AS (SELECT unit, candidate, round(CAST(sum(score) AS DOUBLE) / count(score), 8) AS mean_score, CAST(sum(fit_rows) AS BIGINT) AS fit_rows,
 {', '.join(f"CAST(max(CASE WHEN split = {k} THEN score END) AS DOUBLE) AS split_{k}" for k in range(1, C.MAX_SPLITS + 1))}
 FROM c GROUP BY ALL)
SELECT *, CAST(rank() OVER (PARTITION BY unit ORDER BY mean_score) AS INTEGER) AS rank FROM a""", "daily_usage"))
def search_summary(spark, sf):
    scores = _window_metrics(spark, sf).where(F.col("part") == "test").select(
        "unit", F.concat(F.lit("mean"), F.col("window").cast("string")).alias("candidate"), "split",
        F.col("mape").cast("decimal(18,6)").alias("score"), F.col("window").alias("fit_rows"))
    return M.search_summary(scores, "unit")


_METRICS = ("rmse", "mae", "mape", "smape", "share_outside")


@query("backtest_summary", compose(f"""
WITH {_LABELLED}, m AS ({_METRIC_SQL.format(keys='unit, split, part, "window"', rows=_WINDOW_BLOCKS)}),
l AS ({' UNION ALL '.join(f"SELECT unit, part, '{n}' AS metric, {n} AS value FROM m WHERE split = 1 AND \"window\" = 28" for n in _METRICS)})
SELECT unit, metric, max(CASE WHEN part = 'train' THEN value END) AS train, max(CASE WHEN part = 'test' THEN value END) AS test
FROM l GROUP BY unit, metric""", "daily_usage"))
def backtest_summary(spark, sf):
    metrics = _window_metrics(spark, sf).where((F.col("split") == 1) & (F.col("window") == 28))
    return M.backtest_summary(metrics, "unit", _METRICS)


@query("completeness_check", compose(f"""
WITH known AS (SELECT DISTINCT {key('region', 'segment')} || '{C.KEY_SUFFIX}' AS unit_key FROM accounts)
SELECT vintage, score_run_at, CAST((SELECT count(*) FROM known) * {_H} AS BIGINT) AS expected, count(unit_key) AS found,
 count(unit_key) = (SELECT count(*) FROM known) * {_H} AND count(DISTINCT unit_key) = (SELECT count(*) FROM known) AS complete
FROM unit_forecast LEFT JOIN known ON ts_key = unit_key GROUP BY vintage, score_run_at""", "unit_forecast", "accounts"))
def completeness_check(spark, sf):
    """The units of all accounts are expected in every run."""
    units = T.accounts(spark, sf).select(F.concat(series_key(F.col("region"), F.col("segment")), F.lit(C.KEY_SUFFIX)).alias("ts_key"))
    return M.completeness_check(I.unit_forecast(spark, sf), "ts_key", ["vintage", "score_run_at"], _H, units)
