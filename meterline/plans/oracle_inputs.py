"""The input tables as ANSI SQL (DuckDB dialect), for the correctness check only."""

from __future__ import annotations

from .. import config as C

_FOLDED = ", ".join(f"'{r}'" for r in C.FOLDED_REGIONS)


def fiscal_code(d: str) -> str:
    return (f"CAST(year(({d}) + INTERVAL 11 MONTH) * 100 + quarter(({d}) + INTERVAL 11 MONTH) AS INTEGER)")


def quarter_start(d: str) -> str:
    return f"CAST(date_trunc('quarter', ({d}) - INTERVAL 1 MONTH) + INTERVAL 1 MONTH AS DATE)"


def quarter_end(d: str) -> str:
    return f"CAST({quarter_start(d)} + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)"


def month_start(d: str) -> str:
    return f"CAST(date_trunc('month', {d}) AS DATE)"


def week_start(d: str) -> str:
    return f"CAST(date_trunc('week', {d}) AS DATE)"


def next_monday(d: str) -> str:
    """First Monday after the day."""
    return f"CAST(date_trunc('week', {d}) + INTERVAL 7 DAY AS DATE)"


def scaled(x: str, num: int, den: int) -> str:
    return (f"CAST(CAST((CAST(floor(({x}) * 10000) AS BIGINT) * {num}) // {den} AS DECIMAL(18,0)) * 0.0001 "
            f"AS DECIMAL(18,4))")


def mean(x: str) -> str:
    return f"CAST(CAST(sum({x}) AS DOUBLE) / count({x}) AS DECIMAL(28,6))"


def key(region: str, segment: str) -> str:
    return f"{region} || CASE WHEN {region} IN ({_FOLDED}) THEN 'ALL' ELSE {segment} END"


def rules(text: str, table, default: str) -> str:
    whens = " ".join(f"WHEN {text} LIKE '{p}' THEN '{label}'" for p, label in table)
    return f"CASE {whens} ELSE {default} END"


def key_region(k: str) -> str:
    return rules(f"lower({k})", C.REGION_RULES, f"'{C.NO_REGION}'")


def key_segment(k: str) -> str:
    return rules(f"trim(lower({k}))", C.SEGMENT_RULES, f"'{C.NO_SEGMENT}'")


def renamed(region: str) -> str:
    whens = " ".join(f"WHEN upper({region}) = '{a}' THEN '{b}'" for a, b in C.REGION_RENAME.items())
    return f"CASE {whens} ELSE {region} END"


#: The clock of the queries: the day after the last loaded one.
AS_OF = "(SELECT CAST(max(CAST(l_shipdate AS DATE)) + 1 AS DATE) FROM lineitem)"


#: End of the newest whole fiscal quarter, its last Monday (the newest vintage), and the clock of the published tables.
QUARTER_END = f"CAST({quarter_start(AS_OF)} - 1 AS DATE)"
LAST_VINTAGE = f"CAST(date_trunc('week', {QUARTER_END}) AS DATE)"
REPORT_DAY = f"CAST({QUARTER_END} - {C.REPORT_DAYS_BEFORE_END} AS DATE)"
RECENT_MONTH = f"CAST(date_trunc('month', {AS_OF} - to_months({C.RECENT_MONTHS})) AS DATE)"


def _back(steps: int) -> str:
    return f"CAST({LAST_VINTAGE} - {steps * C.VINTAGE_STEP} AS DATE)"


def _d(day) -> str:
    return f"DATE '{day}'"


_MONTHLY = """
SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, account_id, account_name,
       o_orderstatus AS platform, region, segment, unit, sub_unit, o_orderpriority AS kind,
       CAST(o_totalprice AS DECIMAL(18,4)) AS dollars
FROM orders JOIN accounts ON o_custkey = c_custkey WHERE account_balance {which}"""

def _bounds(y: str) -> str:
    return f"{y} AS y, {scaled(y, 9, 10)} AS y_lower, {scaled(y, 11, 10)} AS y_upper"


_CARVED = f"(segment = '{C.CARVE_OUT_SEGMENT}' AND sub_unit = '{C.CARVE_OUT_SUB_UNIT}')"

# name -> (text, names it reads)
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "accounts": (f"""
SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS account_id, c_name AS account_name,
       c_acctbal AS account_balance, rg AS region, c_mktsegment AS segment,
       CASE WHEN rg IN ({_FOLDED}) THEN rg ELSE rg || ' ' || c_mktsegment END AS unit,
       rg || '_' || n_name AS sub_unit
FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN (SELECT r_regionkey, replace(r_name, ' ', '_') AS rg FROM region) r ON n_regionkey = r_regionkey""", ()),
    "daily_usage": ("""
SELECT CAST(l_shipdate AS DATE) AS date, account_id, account_name, l_linestatus AS platform, region, segment,
       unit, sub_unit, l_returnflag AS kind,
       CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS dollars,
       o_orderpriority AS priority, account_balance
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN accounts ON o_custkey = c_custkey""", ("accounts",)),
    "monthly_private": (_MONTHLY.format(which=f">= {C.PRIVATE_FROM}"), ("accounts",)),
    "monthly_public": (_MONTHLY.format(which=f"< {C.PUBLIC_BELOW}"), ("accounts",)),
    "monthly_usage": ("SELECT *, 'private' AS source FROM monthly_private UNION ALL "
                      "SELECT *, 'public' AS source FROM monthly_public", ("monthly_private", "monthly_public")),
    "key_days": (f"""
SELECT date, {key('region', 'segment')} AS key, {_CARVED} AS carved, CAST(sum(dollars) AS DECIMAL(18,4)) AS dollars
FROM daily_usage GROUP BY ALL""", ("daily_usage",)),
    "vintages": (f"""
SELECT CAST(l - CAST(k * {C.VINTAGE_STEP} AS INTEGER) AS DATE) AS vintage
FROM (SELECT {LAST_VINTAGE} AS l, (SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem) AS f), generate_series(0, (l - f - 1) // {C.VINTAGE_STEP}) g(k)""", ()),
    "model_forecast": (f"""
WITH members AS (
  SELECT date, CASE WHEN carved THEN '{C.CARVE_OUT_KEY}' ELSE key END AS key, 'naive7' AS model, dollars FROM key_days
  UNION ALL SELECT date, key, 'naive28', dollars FROM key_days),
seen AS (
  SELECT key, model, vintage, date, dollars FROM members JOIN vintages
  ON date >= vintage - 28 AND date < vintage),
pairs AS (SELECT DISTINCT key, model, vintage FROM seen),
days AS (SELECT key, model, vintage, vintage + CAST(n AS INTEGER) AS date
         FROM pairs, generate_series(0, {C.DAILY_HORIZON - 1}) g(n)),
weekday AS (SELECT key, model, vintage, dayofweek(date) AS dow, sum(dollars) AS s FROM seen GROUP BY ALL),
total AS (SELECT key, model, vintage, sum(dollars) AS s FROM seen GROUP BY ALL),
paths AS (
  SELECT d.key, d.model, d.vintage, d.date,
         CASE WHEN d.model = 'naive7' THEN {scaled('coalesce(w.s, 0)', 1, 4)} ELSE {scaled('t.s', 1, 28)} END AS y
  FROM days d
  LEFT JOIN weekday w ON w.key = d.key AND w.model = d.model AND w.vintage = d.vintage AND w.dow = dayofweek(d.date)
  JOIN total t ON t.key = d.key AND t.model = d.model AND t.vintage = d.vintage)
SELECT key || '{C.KEY_SUFFIX}' AS ts_key, model, 'na' AS run_id, date, {_bounds('y')},
       CAST(vintage AS TIMESTAMP) + INTERVAL 6 HOUR AS train_run_at,
       CAST(vintage AS TIMESTAMP) + INTERVAL 6 HOUR AS score_run_at, vintage
FROM paths""", ("key_days", "vintages")),
    "ensemble": (f"""
WITH per_model AS (
  SELECT CASE WHEN ts_key = '{C.CARVE_OUT_KEY}{C.KEY_SUFFIX}' THEN '{C.CARVE_OUT_PARENT}{C.KEY_SUFFIX}'
              ELSE ts_key END AS ts_key, date, model, vintage,
         sum(y) AS y, sum(y_lower) AS y_lower, sum(y_upper) AS y_upper
  FROM model_forecast GROUP BY 1, 2, 3, 4)
SELECT ts_key, date, vintage, {mean('y')} AS y, {mean('y_lower')} AS y_lower, {mean('y_upper')} AS y_upper
FROM per_model GROUP BY ts_key, date, vintage""", ("model_forecast",)),
    "unit_forecast": (f"""
SELECT *, CAST(vintage AS TIMESTAMP) + INTERVAL 6 HOUR AS score_run_at, TRUE AS is_active FROM ensemble
UNION ALL
SELECT ts_key, date, vintage, {scaled('y', 102, 100)}, {scaled('y_lower', 102, 100)}, {scaled('y_upper', 102, 100)},
       CAST(vintage AS TIMESTAMP) + INTERVAL 12 HOUR, TRUE FROM ensemble WHERE vintage = {_back(C.TWO_RUNS_BACK)}
UNION ALL
SELECT ts_key, date, vintage, {scaled('y', 200, 100)}, {scaled('y_lower', 200, 100)}, {scaled('y_upper', 200, 100)},
       CAST(vintage AS TIMESTAMP) + INTERVAL 12 HOUR, FALSE FROM ensemble
WHERE vintage = {_back(C.SWITCHED_OFF_BACK)}""", ("ensemble",)),
    "raw_model_output": (f"""
WITH days AS (SELECT date, key, CAST(sum(dollars) AS DECIMAL(18,4)) AS y FROM key_days GROUP BY ALL),
named AS (SELECT *, regexp_replace(key, '({'|'.join(C.SEGMENTS)}|ALL)$', '') AS region FROM days)
SELECT '''' || region || '''' AS region, '''' || substr(key, length(region) + 1) || '''' AS segment,
       CAST(date AS TIMESTAMP) AS ts, y AS forecast, {scaled('y', 9, 10)} AS forecast_lower,
       {scaled('y', 11, 10)} AS forecast_upper,
       CAST(date AS TIMESTAMP) + INTERVAL 461 MINUTE AS run_at, {week_start('date')} AS vintage
FROM named""", ("key_days",)),
    "unit_forecast_monthly": (f"""
WITH months AS (
  SELECT make_date(year, month, 1) AS month_start, {key('region', 'segment')} AS key, sum(dollars) AS dollars
  FROM monthly_usage GROUP BY ALL),
v AS (SELECT CAST(a + to_months(CAST(k AS INTEGER)) AS DATE) AS vintage
  FROM (SELECT min(month_start) AS a, date_diff('month', min(month_start), {REPORT_DAY}) AS n FROM months), generate_series(1, n) g(k)),
sums AS (
  SELECT key, vintage, sum(dollars) AS total FROM months JOIN v
  ON month_start >= vintage - INTERVAL 3 MONTH AND month_start < vintage GROUP BY key, vintage),
paths AS (SELECT key, vintage, {scaled('total', 1, 3)} AS y, CAST(vintage + to_months(CAST(n AS INTEGER)) AS DATE) AS date
          FROM sums, generate_series(0, {C.MONTHLY_HORIZON - 1}) g(n))
SELECT key || '{C.KEY_SUFFIX}' AS ts_key, vintage, date, {_bounds('y')},
       CAST(vintage AS TIMESTAMP) + INTERVAL 9 HOUR AS score_run_at, TRUE AS is_active
FROM paths""", ("monthly_usage",)),
    "plan": (f"""
WITH months AS (
  SELECT {month_start('date')} AS m, platform, unit, sum(dollars) AS dollars FROM daily_usage
  WHERE date <= {QUARTER_END}
  GROUP BY ALL),
kinds AS (SELECT m, 'Platform' AS plan_kind, platform, sum(dollars) AS dollars FROM months GROUP BY ALL
         UNION ALL SELECT m, 'Business Unit', unit, sum(dollars) FROM months GROUP BY ALL)
SELECT CAST({next_monday(f"({quarter_start('m')} - 1)")} AS TIMESTAMP) AS as_of_date, plan_kind, platform,
       year(m) AS year, month(m) AS month, {scaled('dollars', 105, 100)} AS dollars
FROM kinds""", ("daily_usage",)),
    "usage_snapshots": (f"""
SELECT u.* REPLACE (CASE WHEN date >= vintage - 3 THEN {scaled('dollars', 97, 100)} ELSE dollars END AS dollars),
       vintage AS snapshot_date
FROM daily_usage u JOIN vintages ON date < vintage
 AND vintage <= {quarter_end(f"({quarter_end('date')} + 1)")}""", ("daily_usage", "vintages")),
    "account_week": (f"""
WITH weekly AS (
  SELECT account_id, {week_start('date')} AS week_start, sum(dollars) AS amount,
         sum(dollars) FILTER (kind = 'A') AS usage_a, sum(dollars) FILTER (kind = 'N') AS usage_n,
         sum(dollars) FILTER (kind = 'R') AS usage_r, sum(dollars) FILTER (priority = '1-URGENT') AS usage_urgent,
         count(*) FILTER (kind = 'A') AS a, count(*) FILTER (kind = 'N') AS n, count(*) FILTER (kind = 'R') AS r
  FROM daily_usage GROUP BY 1, 2),
newest AS (SELECT {week_start('max(CAST(l_shipdate AS DATE))')} AS w FROM lineitem),
spans AS (
  SELECT account_id, min(week_start) AS first_week, max(week_start) AS last_week,
         CASE WHEN sum(a) >= sum(n) AND sum(a) >= sum(r) THEN 'A' WHEN sum(n) >= sum(r) THEN 'N' ELSE 'R' END AS main_kind
  FROM weekly GROUP BY account_id),
spine AS (
  SELECT account_id, first_week, last_week, main_kind, CAST(d AS DATE) AS week_start
  FROM spans, newest, generate_series(first_week, w, INTERVAL 7 DAY) g(d)),
dense AS (
  SELECT s.*, coalesce(amount, 0) AS amount, coalesce(usage_a, 0) AS usage_a, coalesce(usage_n, 0) AS usage_n,
         coalesce(usage_r, 0) AS usage_r, coalesce(usage_urgent, 0) AS usage_urgent
  FROM spine s LEFT JOIN weekly w ON w.account_id = s.account_id AND w.week_start = s.week_start),
windowed AS (
  SELECT *, sum(amount) OVER (PARTITION BY account_id ORDER BY week_start ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS last_12,
         {', '.join(f"lag(amount, {k}) OVER (PARTITION BY account_id ORDER BY week_start) AS lag_{k}" for k in range(1, 5))}
  FROM dense),
o AS (SELECT CAST(o_custkey AS VARCHAR) AS account_id, count(*) AS orders_total,
             CAST({mean('CAST(o_totalprice AS DECIMAL(18,4))')} AS DOUBLE) AS mean_order_price
      FROM orders GROUP BY 1)
SELECT w.account_id, week_start,
       CAST((week_start - {_d(C.EPOCH_MONDAY)}) // 7 AS INTEGER) AS week,
       CAST((first_week - {_d(C.EPOCH_MONDAY)}) // 7 AS INTEGER) AS start_week,
       CAST((last_week - {_d(C.EPOCH_MONDAY)}) // 7 AS INTEGER) AS end_week,
       CAST(amount AS DOUBLE) AS dollars,
       CASE WHEN NOT (account_balance BETWEEN 0 AND 100) THEN last_12 = 0 END AS idle_12_weeks,
       CASE WHEN account_balance >= 2000 THEN 1 ELSE 0 END AS real, region, sub_unit, segment, unit, main_kind,
       CASE WHEN account_balance < 0 THEN 'debit' WHEN account_balance < 5000 THEN 'low' ELSE 'high' END AS balance_band,
       account_balance, CAST(orders_total AS DOUBLE) AS orders_total, mean_order_price,
       CAST(usage_a AS DOUBLE) AS usage_a, CAST(usage_n AS DOUBLE) AS usage_n, CAST(usage_r AS DOUBLE) AS usage_r,
       CAST(usage_urgent AS DOUBLE) AS usage_urgent,
       CASE WHEN amount = 0 THEN CAST('infinity' AS DOUBLE)
            ELSE round(account_balance / CAST(amount AS DOUBLE), 6) END AS balance_per_dollar,
       {', '.join(f"CAST(lag_{k} AS DOUBLE) AS lag_{k}" for k in range(1, 5))}
FROM windowed w JOIN o ON o.account_id = w.account_id JOIN accounts t ON t.account_id = w.account_id""", ("daily_usage", "accounts")),
}


def predictions(weeks: int) -> str:
    return f"""
WITH recent AS (
  SELECT account_id, week_start, CAST(dollars AS DECIMAL(18,4)) AS dollars, real, idle_12_weeks,
         sum(CAST(dollars AS DECIMAL(18,4))) OVER (PARTITION BY account_id ORDER BY week_start
             ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS four_weeks
  FROM account_week)
SELECT account_id, CAST({scaled('four_weeks', 1, 4)} - dollars AS DECIMAL(18,4)) AS prediction, dollars,
       CAST(n AS INTEGER) AS week_ahead, week_start + 7 AS train_date, real, idle_12_weeks
FROM recent, generate_series(1, {weeks}) g(n)
WHERE week_start > (SELECT max(week_start) FROM account_week) - {7 * C.ACCOUNT_VINTAGES}"""


VIEWS["account_predictions"] = (predictions(C.ACCOUNT_WEEK_HORIZON), ("account_week",))


def compose(text: str, *views: str) -> str:
    """Put the named views, and those they read, in front of a query as common table expressions."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for needed in VIEWS[name][1]:
                add(needed)
            ordered.append(name)

    for name in views:
        add(name)
    if not ordered:
        return text
    head = ",\n".join(f"{name} AS ({VIEWS[name][0]})" for name in ordered)
    body = text.lstrip()
    if body.startswith("WITH "):  # its own common table expressions follow the views
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"
