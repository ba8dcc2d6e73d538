"""Queries on calendars and series (A1, A2)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import config as C
from ..operators import calendar as cal
from ..operators import series as S
from ..sources import tables as T
from ..sources.shared import shared, stored
from . import inputs as I
from .inputs import as_of
from .oracle_inputs import AS_OF, VIEWS, compose, fiscal_code, month_start, quarter_end, quarter_start
from .registry import query


@shared
def unit_days(spark, sf):
    """Daily unit series, stored: frames, terms and splits read it several times, usage is scanned once."""
    return stored(S.daily_series(T.daily_usage(spark, sf), "unit"))


#: The same in SQL.
VIEWS["unit_days"] = ("SELECT date, unit, sum(dollars) AS dollars FROM daily_usage GROUP BY date, unit", ("daily_usage",))


def _days(spark, sf):
    """Days with usage and their row count."""
    return (T.read(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("date"))
            .agg(F.count("*").alias("usage_rows")))


_DAYS = "SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS usage_rows FROM lineitem GROUP BY 1"
_FQ = "quarter(date + INTERVAL 11 MONTH)"
_FY = "year(date + INTERVAL 11 MONTH)"


@query("fiscal_quarter", f"SELECT date, usage_rows, {fiscal_code('date')} AS fiscal_code FROM ({_DAYS})")
def fiscal_quarter(spark, sf):
    return cal.with_fiscal_code(_days(spark, sf), "date")


@query("quarter_bounds", f"""SELECT date, usage_rows, {quarter_start('date')} AS quarter_start,
 {quarter_end('date')} AS quarter_end FROM ({_DAYS})""")
def quarter_bounds(spark, sf):
    return cal.with_quarter_bounds(_days(spark, sf), "date")


@query("fiscal_year_quarter", compose(f"""
SELECT vintage, date, count(*) AS series,
 CAST(quarter(vintage + INTERVAL 11 MONTH) AS INTEGER) AS run_quarter,
 CAST(year(vintage + INTERVAL 11 MONTH) AS INTEGER) AS run_year,
 CAST({_FQ} AS INTEGER) AS target_quarter, CAST({_FY} AS INTEGER) AS target_year
FROM unit_forecast GROUP BY vintage, date""", "unit_forecast"))
def fiscal_year_quarter(spark, sf):
    pairs = I.unit_forecast(spark, sf).groupBy("vintage", "date").agg(F.count("*").alias("series"))
    return cal.with_fiscal_parts(cal.with_fiscal_parts(pairs, "vintage", "run"), "date", "target")


@query("next_fiscal_quarter", f"""
SELECT date, usage_rows, CAST(q AS INTEGER) AS quarter, CAST(y AS INTEGER) AS year,
 CAST(CASE WHEN q = 4 THEN 1 ELSE q + 1 END AS INTEGER) AS next_quarter,
 CAST(CASE WHEN q = 4 THEN y + 1 ELSE y END AS INTEGER) AS next_year,
 'q' || q AS quarter_label, 'q' || CASE WHEN q = 4 THEN 1 ELSE q + 1 END AS next_quarter_label
FROM (SELECT *, {_FQ} AS q, {_FY} AS y FROM ({_DAYS}))""")
def next_fiscal_quarter(spark, sf):
    return cal.with_next_quarter(_days(spark, sf), "date")


@query("monthly_lag_cutoffs", f"""
SELECT date, usage_rows,
 CAST(date_trunc('month', date) - CASE WHEN day(date) <= {C.CLOSE_DAY} THEN INTERVAL 2 MONTH ELSE INTERVAL 1 MONTH END AS DATE)
   AS last_actual_month,
 CAST(date_trunc('month', date) - CASE WHEN day(date) <= {C.CLOSE_DAY} THEN INTERVAL 1 MONTH ELSE INTERVAL 0 MONTH END AS DATE)
   AS monthly_vintage
FROM ({_DAYS})""")
def monthly_lag_cutoffs(spark, sf):
    return cal.with_monthly_cutoffs(_days(spark, sf), "date")


@query("calendar_spine", compose("""
SELECT unit, 'day' AS grain, CAST(d AS DATE) AS date
FROM (SELECT unit, min(date) AS a, max(date) AS b FROM daily_usage GROUP BY unit), generate_series(a, b, INTERVAL 1 DAY) g(d)
UNION ALL
SELECT unit, 'month', CAST(d AS DATE)
FROM (SELECT unit, date_trunc('month', min(date)) AS a, max(date) AS b FROM daily_usage GROUP BY unit),
 generate_series(a, CAST(b AS TIMESTAMP), INTERVAL 1 MONTH) g(d)""", "daily_usage"))
def calendar_spine(spark, sf):
    usage = T.daily_usage(spark, sf)
    days = cal.calendar_spine(usage, "unit", "date").withColumn("grain", F.lit("day"))
    months = cal.calendar_spine(usage, "unit", "date", "1 month").withColumn("grain", F.lit("month"))
    return days.unionByName(months)


# --- series ------------------------------------------------------------------------------

_UNIT_SERIES = "SELECT date, {key}, sum(dollars) AS dollars FROM daily_usage GROUP BY date, {key}"
_AS_DOUBLE = "SELECT * REPLACE (CAST(dollars AS DOUBLE) AS dollars) FROM ({})"


@query("unit_daily_series", compose("""
SELECT date, unit, CAST(sum(dollars) AS DOUBLE) AS dollars FROM daily_usage
WHERE date <= (SELECT max(date) FROM daily_usage) GROUP BY date, unit""", "daily_usage"))
def unit_daily_series(spark, sf):
    return S.daily_series(T.daily_usage(spark, sf), "unit")


@query("sub_unit_daily_series", compose("""
SELECT date, sub_unit, CAST(sum(dollars) AS DOUBLE) AS dollars FROM daily_usage
WHERE date <= (SELECT max(date) FROM daily_usage) GROUP BY date, sub_unit""", "daily_usage"))
def sub_unit_daily_series(spark, sf):
    return S.daily_series(T.daily_usage(spark, sf), "sub_unit")


def _monthly_sql(key: str) -> str:
    return f"""
SELECT {key}, last_day(make_date(year, month, 1)) AS date, sum(dollars) AS dollars FROM monthly_usage
WHERE make_date(year, month, 1) < date_trunc('month', {AS_OF}) GROUP BY ALL"""


def _monthly(spark, sf, key):
    return S.monthly_series(I.monthly_usage(spark, sf), key, None, S.monthly_history_end(as_of(spark, sf)))


@shared
def monthly_sub_units(spark, sf):
    return _monthly(spark, sf, "sub_unit")


@query("monthly_union_series", compose(_AS_DOUBLE.format(_monthly_sql("unit")), "monthly_usage"))
def monthly_union_series(spark, sf):
    return _monthly(spark, sf, "unit")


@query("account_monthly_series", compose(f"""
SELECT account_id, CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month,
 CAST(sum(dollars) AS DOUBLE) AS dollars FROM monthly_usage
WHERE account_id IN (SELECT account_id FROM monthly_usage GROUP BY account_id, source HAVING count(*) > {C.MIN_ROWS_SERIES})
GROUP BY 1, 2, 3""", "monthly_usage"))
def account_monthly_series(spark, sf):
    return S.account_monthly_series(I.monthly_usage(spark, sf))


_FRAME_DAILY = f"""
SELECT unit, date, dollars FROM ({_UNIT_SERIES.format(key='unit')})
UNION ALL
SELECT unit, CAST(m + CAST(n AS INTEGER) AS DATE), NULL
FROM (SELECT DISTINCT unit FROM daily_usage), (SELECT max(date) AS m FROM daily_usage),
 generate_series(1, {C.DAILY_HORIZON}) g(n)"""


def _frame_monthly_sql(key: str) -> str:
    return f"""
SELECT {key}, date, dollars FROM ({_monthly_sql(key)})
UNION ALL
SELECT {key}, last_day(CAST({AS_OF} + to_months(CAST(n AS INTEGER)) AS DATE)), NULL
FROM (SELECT DISTINCT {key} FROM ({_monthly_sql(key)})), generate_series(0, {C.MONTHLY_HORIZON - 1}) g(n)"""


@query("future_frame_daily", compose(_AS_DOUBLE.format(_FRAME_DAILY), "daily_usage"))
def future_frame_daily(spark, sf):
    return S.future_frame_daily(unit_days(spark, sf), "unit")


@query("future_frame_monthly", compose(_AS_DOUBLE.format(_frame_monthly_sql("unit")), "monthly_usage"))
def future_frame_monthly(spark, sf):
    return S.future_frame_monthly(_monthly(spark, sf, "unit"), "unit", as_of(spark, sf))


@query("sub_unit_monthly_series", compose(_AS_DOUBLE.format(_frame_monthly_sql("sub_unit")), "monthly_usage"))
def sub_unit_monthly_series(spark, sf):
    return S.future_frame_monthly(monthly_sub_units(spark, sf), "sub_unit", as_of(spark, sf))


#: The last part of the history, as long as the horizon, is held out.
TEST_START = f"({AS_OF} - {C.DAILY_HORIZON})"


def _hot(expr: str, values: dict, prefix: str) -> list[str]:
    return [f"CAST({expr} = {v} AS INTEGER) AS \"{prefix}_{n}\"" for v, n in values.items()]


def _target_sql(start: str) -> str:
    return f"CASE WHEN date < {start} THEN CAST(dollars AS DOUBLE) END AS dollars"


_MONTH_COLUMNS = (_hot("month(date)", {i + 1: n for i, n in enumerate(S.MONTHS)}, "month")
                  + _hot("quarter(date)", {q: q for q in range(1, 5)}, "quarter"))
_FLAG_SQL = {
    "is_month_start": "(day(date) = 1)",
    "is_month_end": "(last_day(date) = date)",
    "is_quarter_start": "(day(date) = 1 AND month(date) IN (1, 4, 7, 10))",
    "is_quarter_end": "(last_day(date) = date AND month(date) IN (3, 6, 9, 12))",
}
_DAY_COLUMNS = (_hot("dayofweek(date)", dict(enumerate(S.WEEKDAYS)), "day") + _MONTH_COLUMNS
                + _hot("week(date)", {w: w for w in range(1, 54)}, "week")
                + [f"CAST({flag} = {value} AS INTEGER) AS \"{name}_{value}\""
                   for name, flag in _FLAG_SQL.items() for value in ("True", "False")])


@query("calendar_regressors_daily", compose(
    f"SELECT unit, date, {_target_sql(TEST_START)}, {', '.join(_DAY_COLUMNS)} FROM ({_FRAME_DAILY})", "daily_usage"))
def calendar_regressors_daily(spark, sf):
    return S.calendar_regressors_daily(future_frame_daily(spark, sf), "unit", as_of(spark, sf) - dt.timedelta(days=C.DAILY_HORIZON))


@query("calendar_regressors_monthly", compose(
    f"SELECT unit, date, {_target_sql(AS_OF)}, {', '.join(_MONTH_COLUMNS)} FROM ({_frame_monthly_sql('unit')})",
    "monthly_usage"))
def calendar_regressors_monthly(spark, sf):
    return S.calendar_regressors_monthly(future_frame_monthly(spark, sf), "unit", as_of(spark, sf))


def _curve_sql(cohort: int) -> str:
    rows = ", ".join("('{}', '{}', {})".format(unit, shape, ", ".join(repr(c) for c in coefficients))
                     for unit, year, shape, *coefficients in C.CURVES if year == cohort)
    c = [f"CAST(c{i} AS DOUBLE)" for i in range(5)]
    return f"""LEFT JOIN (
 SELECT u, shape, {', '.join(f'{c[i]} AS c{i}' for i in range(5))} FROM (VALUES {rows}) t(u, shape, c0, c1, c2, c3, c4)) k{cohort}
 ON k{cohort}.u = s.unit"""


def _growth_sql(cohort: int) -> str:
    k, n = f"k{cohort}", "CAST(n AS DOUBLE)"
    return f"""round(CASE {k}.shape WHEN 'exponential' THEN {k}.c0 * exp({k}.c1 * {n}) WHEN 'linear' THEN {k}.c0 + {k}.c1 * {n}
 WHEN 'polynomial' THEN {k}.c0 + {n} * ({k}.c1 + {n} * ({k}.c2 + {n} * ({k}.c3 + {n} * {k}.c4))) END, 6) AS growth_{cohort}"""


@query("growth_curve_features", compose(f"""
SELECT s.unit, s.date, CAST(s.dollars AS DOUBLE) AS dollars, CAST(n AS INTEGER) AS row_number,
 {', '.join(_growth_sql(y) for y in C.CURVE_COHORTS)}
FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY date) AS n FROM ({_FRAME_DAILY})) s
{' '.join(_curve_sql(y) for y in C.CURVE_COHORTS)}""", "daily_usage"))
def growth_curve_features(spark, sf):
    """Growth curves over history and horizon."""
    return S.growth_curve_features(future_frame_daily(spark, sf), T.curves(spark))


_EVENT_FLAGS = ", ".join(f"coalesce(max(CAST(name = '{n}' AS INTEGER)), 0) AS event_{n}" for n, _, _ in C.EVENT_RULES)
_EVENTS = ", ".join(f"('{n}', {m}, {d})" for n, m, d in C.EVENT_RULES)


@query("event_regressors", compose(f"""
WITH s AS ({_FRAME_DAILY}),
e AS (SELECT name, make_date(CAST(y AS INTEGER), m, d) AS day FROM (VALUES {_EVENTS}) t(name, m, d),
      (SELECT year(min(date)) AS a, year(max(date)) AS b FROM s), generate_series(a - 1, b + 1) g(y))
SELECT unit, date, CAST(any_value(dollars) AS DOUBLE) AS dollars, {_EVENT_FLAGS}
FROM s LEFT JOIN e ON date BETWEEN day - {C.EVENT_DAYS_AROUND} AND day + {C.EVENT_DAYS_AROUND}
GROUP BY unit, date""", "daily_usage"))
def event_regressors(spark, sf):
    """Events over history and horizon."""
    return S.event_regressors(future_frame_daily(spark, sf), "unit")


def _rule_sql(rule: str, *given) -> str:
    if rule == "day":
        return f"make_date(y, {given[0]}, {given[1]})"
    if rule == "easter":
        return f"easter + {given[0]}"
    month, weekday, nth = given
    days = f"range(make_date(y, {month}, 1), make_date(y, {month}, 1) + INTERVAL 1 MONTH, INTERVAL 1 DAY)"
    return f"CAST(list_filter({days}, lambda d: strftime(d, '%a') = '{weekday}')[{nth}] AS DATE)"


_HOLIDAY_LIST = ", ".join(
    f"struct_pack(term := '{name if name in C.SEPARATE_HOLIDAYS else 'other_holiday'}', day := {_rule_sql(rule, *given)})"
    for name, _, rule, *given in C.HOLIDAY_RULES)
_AROUND = range(-C.HOLIDAY_DAYS_AROUND, C.HOLIDAY_DAYS_AROUND + 1)
_HOLIDAY_FLAGS = ", ".join(
    f"coalesce(max(CAST(h.term = '{t}' AND h.day + {k} = s.date AS INTEGER)), 0) AS {t}" + (f"_{'minus' if k < 0 else 'plus'}_{abs(k)}" if k else "")
    for t in (*C.SEPARATE_HOLIDAYS, "other_holiday") for k in _AROUND)


@query("holiday_regressors", compose(f"""
WITH s AS ({_FRAME_DAILY}),
g AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM (SELECT CAST(unnest(range(a - 1, b + 2)) AS INTEGER) AS y
  FROM (SELECT year(min(date)) AS a, year(max(date)) AS b FROM s))),
e1 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM g),
e2 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM e1),
e3 AS (SELECT *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS n FROM e2),
e4 AS (SELECT y, make_date(CAST(y AS BIGINT), CAST(n // 31 AS BIGINT), CAST(n % 31 + 1 AS BIGINT)) AS easter FROM e3),
h AS (SELECT x.term, x.day FROM (SELECT unnest([{_HOLIDAY_LIST}]) AS x FROM e4))
SELECT unit, date, CAST(any_value(dollars) AS DOUBLE) AS dollars, {_HOLIDAY_FLAGS}
FROM s LEFT JOIN h ON s.date BETWEEN h.day - {C.HOLIDAY_DAYS_AROUND} AND h.day + {C.HOLIDAY_DAYS_AROUND}
GROUP BY unit, date""", "daily_usage"))
def holiday_regressors(spark, sf):
    """Holidays and the days around them over history and horizon."""
    return S.holiday_regressors(future_frame_daily(spark, sf), "unit")


_PLACE = {"day": "date_diff('day', DATE '1970-01-01', date)", "month": "(year(date) * 12 + month(date))"}


def _lag_sql(k: int, grain: str) -> str:
    return f"CAST(sum(dollars) OVER (PARTITION BY unit ORDER BY {_PLACE[grain]} RANGE BETWEEN {k} PRECEDING AND {k} PRECEDING) AS DOUBLE)"


def _mean_lag_sql(near: int, far: int, grain: str) -> str:
    frame = f"(PARTITION BY unit ORDER BY {_PLACE[grain]} RANGE BETWEEN {far} PRECEDING AND {near} PRECEDING)"
    return f"round(CAST(sum(dollars) OVER {frame} AS DOUBLE) / nullif(count(dollars) OVER {frame}, 0), 6)"


@query("lag_features", compose(f"""
SELECT unit, 'day' AS grain, date, CAST(dollars AS DOUBLE) AS dollars, {_lag_sql(1, 'day')} AS lag_1, {_lag_sql(7, 'day')} AS lag_7,
 CAST(NULL AS DOUBLE) AS lag_12, CAST(NULL AS DOUBLE) AS lag_24, {_mean_lag_sql(1, 7, 'day')} AS mean_lag
FROM ({_UNIT_SERIES.format(key='unit')})
UNION ALL
SELECT unit, 'month', date, CAST(dollars AS DOUBLE), {_lag_sql(1, 'month')}, NULL, {_lag_sql(12, 'month')}, {_lag_sql(24, 'month')}, {_mean_lag_sql(2, 3, 'month')}
FROM ({_monthly_sql('unit')})""", "daily_usage", "monthly_usage"))
def lag_features(spark, sf):
    daily = S.lag_features(S.daily_series(T.daily_usage(spark, sf), "unit"), "unit", (1, 7), (1, 7))
    monthly = S.lag_features(_monthly(spark, sf, "unit"), "unit", (1, 12, 24), (2, 3), "month")
    return daily.withColumn("grain", F.lit("day")).unionByName(
        monthly.withColumn("grain", F.lit("month")), allowMissingColumns=True)


_ADJUSTMENTS = ", ".join(f"(DATE '{a}', DATE '{b}', {v})" for a, b, v in C.ADJUSTMENTS)


@query("anomaly_adjustment", compose(f"""
SELECT unit, date, CAST(dollars AS DOUBLE) AS dollars,
 CAST(dollars + coalesce((SELECT sum(v) FROM (VALUES {_ADJUSTMENTS}) t(a, b, v) WHERE s.date BETWEEN a AND b), 0) AS DOUBLE) AS adjusted
FROM ({_UNIT_SERIES.format(key='unit')}) s""", "daily_usage"))
def anomaly_adjustment(spark, sf):
    adjustments = T.rule_table(spark, list(C.ADJUSTMENTS), "first_day date, last_day date, delta double")
    return S.anomaly_adjustment(S.daily_series(T.daily_usage(spark, sf), "unit"), "unit", adjustments)


@query("source_ready", compose(f"""
SELECT 'private' AS source, count(*) > 0 AS ready FROM monthly_private
WHERE make_date(year, month, 1) = {month_start(f"({AS_OF} - INTERVAL 1 MONTH)")}
UNION ALL
SELECT 'public', count(*) > 0 FROM monthly_public
WHERE make_date(year, month, 1) = {month_start(f"({AS_OF} - INTERVAL 1 MONTH)")}""", "monthly_private", "monthly_public"))
def source_ready(spark, sf):
    return S.source_ready(T.monthly_private(spark, sf), "private", as_of(spark, sf)).unionByName(
        S.source_ready(T.monthly_public(spark, sf), "public", as_of(spark, sf)))
