"""Queries on the forecast explainer (A8), fitted models excepted."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import explain as X
from ..sources import tables as T
from ..sources.shared import shared, stored
from . import account_queries  # noqa: F401  (its views are used below)
from . import inputs as I
from .oracle_inputs import VIEWS, compose, fiscal_code
from .registry import query

_FEATURES = ", ".join(C.FEATURES)
_POPULATION = "CASE WHEN coalesce(idle_12_weeks, FALSE) OR real = 0 THEN 'small' ELSE 'real' END"
_NEXT = fiscal_code("CAST(run_date + INTERVAL 3 MONTH AS DATE)")
_LABEL = "'q' || quarter(train_date + INTERVAL 11 MONTH)"
_NEXT_LABEL = "'q' || (quarter(train_date + INTERVAL 11 MONTH) % 4 + 1)"


def _weight(name: str) -> str:
    return f"CAST({C.LINEAR_COEFFICIENTS[name]!r} AS DOUBLE)"


_BASE = " + ".join(f"{_weight(n)} * mean_{n}" for n in C.LINEAR_COEFFICIENTS)
_LONG = " UNION ALL ".join(
    f"SELECT account_id, train_date, quarter_explained, population, ({_BASE}) * w AS base_value, '{n}' AS feature, "
    f"{_weight(n)} * (coalesce({n}, 0) - mean_{n}) * w + 0.0 AS contribution FROM sliced" for n in C.LINEAR_COEFFICIENTS)
_CATALOG = ", ".join(f"('{n}', '{k}', {u})" for n, k, u in C.FEATURE_CATALOG)

VIEWS.update({
    "outlook": (f"""
SELECT account_id, train_date, n / CAST(7 AS DOUBLE) AS current_weeks, f AS current_forecast,
 coalesce(f2, 0) AS next_forecast, CASE WHEN n2 > 0 THEN n2 / CAST(7 AS DOUBLE) ELSE 1.0 END AS next_weeks
FROM (SELECT account_id, run_date AS train_date,
  count(*) FILTER ({fiscal_code('run_date')} = {fiscal_code('date')}) AS n,
  sum(forecast) FILTER ({fiscal_code('run_date')} = {fiscal_code('date')}) AS f,
  count(*) FILTER ({_NEXT} = {fiscal_code('date')}) AS n2,
  sum(forecast) FILTER ({_NEXT} = {fiscal_code('date')}) AS f2
 FROM account_days GROUP BY 1, 2) WHERE n > 0""", ("account_days",)),
    "explained": (f"""
SELECT o.account_id, o.train_date, CAST(current_forecast AS DOUBLE) AS current_forecast,
 CAST(current_forecast AS DOUBLE) / current_weeks AS current_weekly_average,
 CAST(next_forecast AS DOUBLE) AS next_forecast,
 CAST(next_forecast AS DOUBLE) / next_weeks AS next_weekly_average, idle_12_weeks, real, {_FEATURES}
FROM outlook o JOIN account_week p ON p.account_id = o.account_id AND p.week_start + 7 = o.train_date""",
                  ("outlook", "account_week")),
    "sliced": (f"""
SELECT e.*, {_POPULATION} AS population, quarter_explained, w, {', '.join(f'mean_{n}' for n in C.LINEAR_COEFFICIENTS)}
FROM (SELECT *, {_POPULATION} AS pop, unnest([{_LABEL}, {_NEXT_LABEL}]) AS quarter_explained,
       unnest([CAST(1.0 AS DOUBLE), CAST(0.5 AS DOUBLE)]) AS w FROM explained) e
JOIN (SELECT train_date AS t, {_POPULATION} AS q,
  {', '.join(f"CAST(CAST(CAST(sum(CAST(coalesce({n}, 0) AS DECIMAL(28,6))) AS DOUBLE) / count(*) AS DECIMAL(28,6)) AS DOUBLE) AS mean_{n}" for n in C.LINEAR_COEFFICIENTS)}
  FROM explained GROUP BY 1, 2) m ON m.t = e.train_date AND m.q = e.pop""", ("explained",)),
    "contributions": (_LONG, ("sliced",)),
    "labelled": (f"""
SELECT c.*, k.kind FROM contributions c JOIN (VALUES {_CATALOG}) k(name, kind, in_use)
 ON k.name = c.feature AND k.in_use = 1""", ("contributions",)),
})


@query("quarter_outlook", compose("""
SELECT * REPLACE (CAST(current_forecast AS DOUBLE) AS current_forecast, CAST(next_forecast AS DOUBLE) AS next_forecast) FROM outlook""",
                                  "outlook"))
def quarter_outlook(spark, sf):
    return X.quarter_outlook(I.account_weekday_forecast(spark, sf))


@query("explain_features", compose("SELECT * FROM explained", "explained"))
def explain_features(spark, sf):
    return X.explain_features(quarter_outlook(spark, sf), I.account_week(spark, sf, C.ACCOUNT_VINTAGES))


@shared
def features(spark, sf):
    return stored(explain_features(spark, sf))


@query("pending_vintages", compose("""
SELECT DISTINCT train_date FROM explained WHERE train_date = (SELECT max(train_date) FROM explained)""", "explained"))
def pending_vintages(spark, sf):
    table = features(spark, sf)
    done = table.where(F.col("train_date") < table.select(F.max("train_date")).scalar())
    return X.pending_vintages(table, done)


@query("vintage_quarter_labels", compose(
    f"SELECT DISTINCT train_date, {_LABEL} AS current_quarter, {_NEXT_LABEL} AS next_quarter FROM explained", "explained"))
def vintage_quarter_labels(spark, sf):
    return X.vintage_quarter_labels(explain_features(spark, sf))


@query("linear_attribution", compose("SELECT * FROM contributions", "contributions"))
def linear_attribution(spark, sf):
    return X.linear_attribution(features(spark, sf))


@query("explainer_master", compose("""
SELECT c.*, n.account_name, n.unit, n.sub_unit FROM contributions c LEFT JOIN (
 SELECT account_id, account_name, unit, sub_unit FROM daily_usage
 UNION SELECT account_id, account_name, unit, sub_unit FROM monthly_usage) n ON n.account_id = c.account_id""",
                                   "contributions", "daily_usage", "monthly_usage"))
def explainer_master(spark, sf):
    names = X.account_names(T.daily_usage(spark, sf), T.monthly_private(spark, sf), T.monthly_public(spark, sf))
    return X.explainer_master(linear_attribution(spark, sf), names)


@query("features_of_kind", compose("SELECT * FROM labelled", "labelled"))
def features_of_kind(spark, sf):
    return X.features_of_kind(linear_attribution(spark, sf), T.feature_catalog(spark))


_ROW = ", ".join(X.ROW)
_ABS = "CAST(abs(contribution) AS DECIMAL(30,9))"


@query("contribution_strength", compose(f"""
SELECT {_ROW}, kind, feature, round(CAST({_ABS} AS DOUBLE) / nullif(CAST(sum({_ABS}) OVER (PARTITION BY {_ROW}, kind) AS DOUBLE), 0), 9) AS strength
FROM labelled""", "labelled"))
def contribution_strength(spark, sf):
    return X.contribution_strength(features_of_kind(spark, sf))


@query("contribution_direction", compose(f"""
SELECT {_ROW}, kind, feature, CASE WHEN contribution > 0 THEN 1 WHEN contribution <= 0 THEN 0 END AS direction FROM labelled""",
                                         "labelled"))
def contribution_direction(spark, sf):
    return X.contribution_direction(features_of_kind(spark, sf))


@query("kind_strength", compose(f"""
SELECT {_ROW}, kind, round(CAST(s AS DOUBLE) / nullif(CAST(sum(s) OVER (PARTITION BY {_ROW}) AS DOUBLE), 0), 9) AS strength
FROM (SELECT {_ROW}, kind, sum({_ABS}) AS s FROM labelled GROUP BY ALL)""", "labelled"))
def kind_strength(spark, sf):
    return X.kind_strength(features_of_kind(spark, sf))


@query("kind_direction", compose(f"""
SELECT {_ROW}, kind, CASE WHEN s > 0 THEN 1 WHEN s <= 0 THEN 0 END AS direction
FROM (SELECT {_ROW}, kind, sum(CAST(contribution AS DECIMAL(30,9))) AS s FROM labelled GROUP BY ALL)""", "labelled"))
def kind_direction(spark, sf):
    return X.kind_direction(features_of_kind(spark, sf))
