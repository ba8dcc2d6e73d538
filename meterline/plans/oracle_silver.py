"""Silver tables as SQL views, added to the input views."""

from __future__ import annotations

from .. import config as C
from .oracle_inputs import (REPORT_DAY as AS_OF, VIEWS, fiscal_code, key_region, key_segment, mean, month_start, renamed)

FOLDED = ", ".join(f"'{r}'" for r in C.FOLDED_RENAMED)
COLUMNS = "series, detail, display, vintage, platform, region, segment, sku, date, quantity, dollars"
# the union of two decimal columns keeps the digits of the shorter one here, so both are widened first
SIX_DIGITS = COLUMNS.replace("dollars", "CAST(dollars AS DECIMAL(28,6)) AS dollars")
NO_QUANTITY = "CAST(NULL AS DOUBLE) AS quantity"
NO_DATE = "CAST(NULL AS DATE)"

_USAGE_LABELS = (f"lower(platform) AS platform, {renamed('region')} AS region, segment, "
                 "lower(kind) || '_usage' AS sku")


def _monthly_actuals(source: str) -> str:
    return f"""
SELECT 'actuals' AS series, 'actuals - monthly' AS detail, 'actuals' AS display, {NO_DATE} AS vintage,
 {_USAGE_LABELS}, make_date(year, month, 1) AS date, {NO_QUANTITY}, sum(dollars) AS dollars
FROM {source} GROUP BY ALL"""


def monthly_asof(limit: str = "TRUE") -> str:
    return f"""
SELECT * EXCLUDE (rank) FROM (
 SELECT v.vintage, m.monthly_vintage, m.region, m.segment, m.date, m.dollars,
  rank() OVER (PARTITION BY v.vintage, m.region, m.segment ORDER BY m.monthly_vintage DESC) AS rank
 FROM vintage_starts v JOIN monthly_by_unit m
  ON {fiscal_code('m.monthly_vintage')} = v.fiscal_code AND {fiscal_code('m.date')} = v.fiscal_code
  AND m.monthly_vintage <= v.vintage AND {limit}) WHERE rank = 1"""


def _repeated(source: str, name: str) -> str:
    return f"""
SELECT v.vintage, 'future forecast - padded actuals {name}' AS detail, a.region,
 CASE WHEN a.region IN ({FOLDED}) THEN 'All' ELSE a.segment END AS segment, a.date, a.dollars
FROM (SELECT region, segment, date, sum(dollars) AS dollars FROM {source} GROUP BY region, segment, date) a
JOIN vintage_starts v ON v.fiscal_code = {fiscal_code('a.date')}"""


def _first_plan(kind: str) -> str:
    return f"""
SELECT min(v) AS first_vintage, max(q) AS fiscal_code FROM (
 SELECT CAST(as_of_date AS DATE) AS v, {fiscal_code('as_of_date')} AS q FROM plan WHERE lower(plan_kind) = '{kind}')
WHERE q = (SELECT max({fiscal_code('as_of_date')}) FROM plan WHERE lower(plan_kind) = '{kind}')"""


VIEWS.update({
    "runs": ("SELECT DISTINCT vintage, score_run_at FROM unit_forecast WHERE is_active", ("unit_forecast",)),
    "frozen": (f"""
SELECT 'actuals' AS series, 'actuals' AS detail, 'actuals' AS display, r.vintage, k.platform, k.region, k.segment, k.sku,
 k.date, {NO_QUANTITY}, k.dollars, r.score_run_at AS pulled_at, {fiscal_code('r.vintage')} AS fiscal_code
FROM runs r JOIN (
 SELECT snapshot_date, {_USAGE_LABELS}, date, sum(dollars) AS dollars FROM usage_snapshots GROUP BY ALL) k
 ON k.snapshot_date = CAST(r.score_run_at AS DATE)""", ("runs", "usage_snapshots")),
    "actuals_daily": (f"""
SELECT {COLUMNS.replace('vintage', f'{NO_DATE} AS vintage')} FROM frozen
WHERE vintage = (SELECT max(vintage) FROM frozen)""", ("frozen",)),
    "actuals_private": (_monthly_actuals("monthly_private"), ("monthly_private",)),
    "actuals_public": (_monthly_actuals("monthly_public"), ("monthly_public",)),
    "actuals_combined": (" UNION ALL ".join(f"SELECT {COLUMNS} FROM actuals_{n}" for n in ("daily", "public", "private")),
                         ("actuals_daily", "actuals_public", "actuals_private")),
    "forecast_daily": (f"""
SELECT 'future forecast' AS series, 'future forecast - daily' AS detail, 'future forecast' AS display, vintage,
 '{C.NO_PLATFORM}' AS platform, {key_region('ts_key')} AS region, {key_segment('ts_key')} AS segment, '{C.NO_SKU}' AS sku,
 date, {NO_QUANTITY}, dollars
FROM (SELECT vintage, ts_key, date, {mean('y')} AS dollars FROM unit_forecast WHERE is_active GROUP BY vintage, ts_key, date)""",
                       ("unit_forecast",)),
    "vintage_starts": (f"SELECT vintage, min(date) AS first_day, {fiscal_code('vintage')} AS fiscal_code "
                       "FROM forecast_daily GROUP BY vintage", ("forecast_daily",)),
    "padded": (f"""
SELECT 'future forecast' AS series, 'future forecast - padded actuals' AS detail, 'future forecast' AS display, v.vintage,
 a.platform, a.region, a.segment, a.sku, a.date, a.quantity, a.dollars
FROM vintage_starts v JOIN actuals_daily a ON {fiscal_code('a.date')} = {fiscal_code('v.first_day')} AND a.date < v.first_day""",
               ("vintage_starts", "actuals_daily")),
    "monthly_by_unit": (f"""
SELECT vintage AS monthly_vintage, {key_region('ts_key')} AS region, {key_segment('ts_key')} AS segment, date, {mean('y')} AS dollars
FROM unit_forecast_monthly WHERE is_active GROUP BY 1, 2, 3, 4""", ("unit_forecast_monthly",)),
    "monthly_asof": (monthly_asof(), ("vintage_starts", "monthly_by_unit")),
    "monthly_actuals_repeated": (_repeated("actuals_private", "private") + " UNION ALL " + _repeated("actuals_public", "public"),
                                 ("vintage_starts", "actuals_private", "actuals_public")),
    "monthly_repeated": (f"""
SELECT 'future forecast' AS series, detail, 'future forecast - monthly' AS display, vintage, '{C.NO_PLATFORM}' AS platform,
 region, segment, '{C.NO_SKU}' AS sku, date, {NO_QUANTITY}, dollars
FROM (SELECT *, rank() OVER (PARTITION BY vintage, region, segment, date ORDER BY p) AS r FROM (
  SELECT vintage, 'future forecast - monthly' AS detail, region, segment, date, dollars, 1 AS p FROM monthly_asof
  UNION ALL SELECT vintage, detail, region, segment, date, dollars, CASE WHEN detail LIKE '%private' THEN 2 ELSE 3 END
  FROM monthly_actuals_repeated)) WHERE r = 1""", ("monthly_asof", "monthly_actuals_repeated")),
    "plan_platform": (f"""
SELECT 'plan - ' || plan_kind AS series, 'plan - ' || plan_kind AS detail, 'plan - ' || plan_kind AS display,
 CAST(as_of_date AS DATE) AS vintage, lower(platform) AS platform, CAST(NULL AS VARCHAR) AS region,
 CAST(NULL AS VARCHAR) AS segment, CAST(NULL AS VARCHAR) AS sku, make_date(year, month, 1) AS date, {NO_QUANTITY}, dollars
FROM plan WHERE lower(plan_kind) = 'platform'""", ("plan",)),
    "plan_unit": (f"""
SELECT 'plan - ' || plan_kind AS series, 'plan - ' || plan_kind AS detail, 'plan - ' || plan_kind AS display,
 CAST(as_of_date AS DATE) AS vintage, CAST(NULL AS VARCHAR) AS platform, {renamed("split_part(platform, ' ', 1)")} AS region,
 CASE WHEN strpos(platform, ' ') > 0 THEN substr(platform, strpos(platform, ' ') + 1) END AS segment,
 CAST(NULL AS VARCHAR) AS sku, make_date(year, month, 1) AS date, {NO_QUANTITY}, dollars
FROM plan WHERE lower(plan_kind) = 'business unit'""", ("plan",)),
    "plan_first": (f"SELECT 'platform' AS plan_kind, * FROM ({_first_plan('platform')}) UNION ALL "
                   f"SELECT 'business unit', * FROM ({_first_plan('business unit')})", ("plan",)),
    "model_first": (f"SELECT {fiscal_code('vintage')} AS fiscal_code, min(vintage) AS first_vintage FROM forecast_daily GROUP BY 1",
                    ("forecast_daily",)),
    "monthly_first": (f"""
SELECT t.* FROM (
 SELECT ts_key, date, vintage, {mean('y_lower')} AS y_lower, {mean('y')} AS y, {mean('y_upper')} AS y_upper
 FROM unit_forecast_monthly WHERE is_active GROUP BY ts_key, date, vintage) t
JOIN (SELECT ts_key, min(vintage) AS vintage FROM unit_forecast_monthly
      WHERE {fiscal_code('vintage')} = {fiscal_code(AS_OF)} AND is_active GROUP BY ts_key) l
 ON t.ts_key = l.ts_key AND t.vintage = l.vintage""", ("unit_forecast_monthly",)),
})

_ACCURACY = ("series, plan_vintage, platform, region, segment, CAST(NULL AS VARCHAR) AS sku, date, plan_quantity, plan_dollars, "
             "actual_quantity, actual_dollars, model_vintage, model_quantity, model_dollars")
_MONTH = month_start("date")

VIEWS.update({
    "accuracy_platform": (f"""
SELECT {_ACCURACY} FROM (
 SELECT p.series, p.vintage AS plan_vintage, a.platform, CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS segment, a.date,
  p.quantity AS plan_quantity, p.dollars AS plan_dollars, a.actual_quantity, a.actual_dollars,
  CAST(NULL AS DATE) AS model_vintage, CAST(NULL AS DOUBLE) AS model_quantity, CAST(NULL AS DOUBLE) AS model_dollars
 FROM (SELECT platform, {_MONTH} AS date, sum(quantity) AS actual_quantity, sum(dollars) AS actual_dollars
       FROM actuals_combined GROUP BY 1, 2) a
 LEFT JOIN (SELECT * REPLACE ('platform' AS series) FROM plan_platform WHERE vintage =
            (SELECT first_vintage FROM plan_first WHERE plan_kind = 'platform')) p
  ON p.platform = a.platform AND p.date = a.date)""", ("actuals_combined", "plan_platform", "plan_first")),
    "accuracy_unit": (f"""
SELECT {_ACCURACY} FROM (
 SELECT p.series, p.vintage AS plan_vintage, CAST(NULL AS VARCHAR) AS platform, a.region, a.segment, a.date,
  p.quantity AS plan_quantity, p.dollars AS plan_dollars, a.actual_quantity, a.actual_dollars,
  m.model_vintage, m.model_quantity, m.model_dollars
 FROM (SELECT region, CASE WHEN region NOT IN ({FOLDED}) THEN segment END AS segment, {_MONTH} AS date,
        sum(quantity) AS actual_quantity, sum(dollars) AS actual_dollars FROM actuals_combined GROUP BY 1, 2, 3) a
 LEFT JOIN (SELECT * REPLACE ('business unit' AS series) FROM plan_unit WHERE vintage =
            (SELECT first_vintage FROM plan_first WHERE plan_kind = 'business unit')) p
  ON p.region = a.region AND p.segment IS NOT DISTINCT FROM a.segment AND p.date = a.date
 LEFT JOIN (
  SELECT region, segment, model_vintage, date, sum(quantity) AS model_quantity, sum(dollars) AS model_dollars FROM (
   SELECT region, CASE WHEN region NOT IN ({FOLDED}) THEN segment END AS segment, vintage AS model_vintage, {_MONTH} AS date,
    quantity, dollars FROM forecast_daily
   WHERE vintage = (SELECT first_vintage FROM model_first WHERE fiscal_code = (SELECT max(fiscal_code) FROM model_first))
   UNION ALL
   SELECT {key_region('ts_key')}, CASE WHEN {key_region('ts_key')} NOT IN ({FOLDED}) THEN {key_segment('ts_key')} END,
    (SELECT min(vintage) FROM forecast_daily WHERE {fiscal_code('vintage')} = {fiscal_code(AS_OF)}), date, NULL, y
   FROM monthly_first) GROUP BY ALL) m
  ON m.region = a.region AND m.segment IS NOT DISTINCT FROM a.segment AND m.date = a.date)""",
                      ("actuals_combined", "plan_unit", "plan_first", "forecast_daily", "model_first", "monthly_first")),
    "accuracy": (f"""
SELECT * FROM (SELECT * FROM accuracy_platform UNION ALL SELECT * FROM accuracy_unit)
WHERE actual_dollars IS NOT NULL AND (model_dollars IS NOT NULL OR plan_dollars IS NOT NULL)
 AND date <> {month_start(AS_OF)} AND {AS_OF} - CAST(date + INTERVAL 1 MONTH AS DATE) >= {C.CLOSE_LAG_DAYS}""",
                 ("accuracy_platform", "accuracy_unit")),
    "tall": ("SELECT * FROM (SELECT *, strftime(date, '%Y-%m') AS month, "
             f"{fiscal_code('vintage')} AS vintage_code, {fiscal_code('date')} AS date_code FROM ("
             + " UNION ALL ".join(f"SELECT {SIX_DIGITS} FROM {n}" for n in (
                 "actuals_combined", "monthly_repeated", "forecast_daily", "padded", "plan_platform", "plan_unit"))
             + ")) WHERE lower(series) = 'actuals' OR vintage_code = date_code",
             ("actuals_combined", "monthly_repeated", "forecast_daily", "padded", "plan_platform", "plan_unit")),
    "monthly_known": (f"SELECT * FROM (SELECT {COLUMNS} FROM actuals_private UNION ALL SELECT {COLUMNS} FROM actuals_public) "
                      f"WHERE date < {month_start(AS_OF)}", ("actuals_private", "actuals_public")),
    "quarter_totals": (f"""
SELECT '{C.NO_PLATFORM}' AS platform, region, segment, '{C.NO_SKU}' AS sku, vintage, 'actuals' AS forecast_type, date,
 avg(quantity) AS quantity, {mean('dollars')} AS dollars
FROM (SELECT region, segment, vintage, date, pulled_at, sum(quantity) AS quantity, sum(dollars) AS dollars FROM frozen
      WHERE date < vintage AND {fiscal_code('date')} = fiscal_code GROUP BY ALL) GROUP BY ALL
UNION ALL
SELECT '{C.NO_PLATFORM}', a.region, a.segment, '{C.NO_SKU}', v.vintage, 'actuals', a.date, NULL, CAST(a.dollars AS DECIMAL(28,6))
FROM (SELECT region, segment, date, sum(dollars) AS dollars FROM monthly_known GROUP BY ALL) a
JOIN (SELECT vintage, max(monthly_vintage) AS monthly_vintage FROM ({monthly_asof("m.date >= date_trunc('month', v.vintage)")})
      GROUP BY vintage) v
 ON {fiscal_code('a.date')} = {fiscal_code('v.vintage')} AND a.date < v.vintage AND a.date < v.monthly_vintage
UNION ALL
SELECT platform, region, segment, sku, vintage, series, date, NULL, CAST(dollars AS DECIMAL(28,6)) FROM forecast_daily WHERE date >= vintage
UNION ALL
SELECT '{C.NO_PLATFORM}', region, segment, '{C.NO_SKU}', vintage, 'monthly forecast', date, NULL, CAST(dollars AS DECIMAL(28,6))
FROM ({monthly_asof("m.date >= (SELECT max(date) FROM monthly_known)")})""",
                       ("frozen", "monthly_known", "forecast_daily", "vintage_starts", "monthly_by_unit")),
})


def select_view(name: str) -> str:
    """All of a view; money as double."""
    return f"SELECT * REPLACE (CAST(dollars AS DOUBLE) AS dollars) FROM {name}"
