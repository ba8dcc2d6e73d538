"""Settings and rule tables.

Everything a deployment would change sits here: horizons, windows, rule tables and the
names of the test data. Operators take these values as arguments with these defaults.
"""

from __future__ import annotations

import datetime as dt

# ---------------------------------------------------------------------------
# Work sizes and model settings that results must agree on.
# ---------------------------------------------------------------------------
DAILY_HORIZON = 124            # days ahead, unit and sub-unit level
MONTHLY_HORIZON = 4            # months ahead, unit level
ACCOUNT_WEEK_HORIZON = 40      # weeks ahead, one model per week
ACCOUNT_MONTH_HORIZON = 12     # months ahead, accounts of the monthly sources
MAX_SPLITS = 4                 # rolling-origin splits
MONTHLY_SPLIT_SPACING = 3      # months between monthly splits
METRIC_PERIODS_DAILY = 30      # days summed before an error is taken
METRIC_PERIODS_MONTHLY = 1
RELATIVE_TOLERANCE = 0.05
COVERAGE_Z = 1.96              # 95% band
EMA_SPAN = 9                   # exponential mean over vintages, not adjusted
WEEKDAY_WINDOW_DAYS = 370
MIN_ROWS_SERIES = 3            # account series: more rows than this in one source
MIN_ROWS_FORECAST = 12         # account forecast: more rows than this in one source
INACTIVE_WEEKS = 7
CLOSE_DAY = 10                 # monthly actuals of month m are complete after this day of m + 1
CLOSE_LAG_DAYS = 9             # accuracy rows appear this many days after the month's end
ROUND_UP_TO = 100_000
REFRESH_DAYS = 4
NEXT_UPDATE_DAYS = 11
TREE_DEPTHS = (3, 5)
TREE_COUNTS = (10, 20)
CV_FOLDS = 3
SEED = 42
SEARCH_BUDGET = 1200           # candidates tried per series
BREAK_COUNTS = (3, 5, 8, 12, 15, 18, 20, 25, 30, 35, 40)   # evenly spaced trend breaks
# Detected trend breaks: strength, resampled to days, days apart, days between possible breaks,
# share of the end without breaks, order of the yearly cycle, days from a given break, keep the detected one.
FOUND_BREAKS = (
    (0.8, 7, 30, 10, 0.3, 4, 30, False),
    (0.5, 10, 60, 20, 0.3, 7, 40, True),
    (0.2, 20, 10, 5, 0.2, 3, 50, False),
    (0.4, 30, 20, 10, 0.05, 6, 30, True),
    (0.6, 40, 40, 7, 0.1, 10, 10, False),
    (0.9, 60, 50, 1, 0.01, 9, 20, False),
)
FOUND_BREAKS_MONTHLY = (
    (0.8, 30, 30, 30, 0.1, 4, 60, False),
    (0.5, 60, 60, 30, 0.01, 7, 60, True),
    (0.2, 90, 30, 60, 0.05, 3, 90, False),
    (0.4, 120, 60, 30, 0.1, 6, 90, True),
    (0.6, 30, 120, 60, 0.1, 10, 30, False),
    (0.9, 60, 90, 30, 0.1, 9, 30, False),
)
# Seasonal breaks: strength, resampled to days, days apart, days between possible breaks, share of the end without breaks.
SEASONAL_BREAKS = (
    (0.5, 7, 30, 10, 0.3),
    (0.8, 30, 60, 20, 0.2),
    (0.1, 30, 90, 10, 0.3),
)
HOLIDAY_DAYS_AROUND = 2
# Fixed dates of public holidays: (name, country, rule, ...); "day": month, day; "weekday": month, day of the week, which one (-1: the
# last); "easter": days from Easter Sunday. Movable feasts of lunar calendars follow no such rule and are left out.
HOLIDAY_RULES = (
    ("new_year", "US", "day", 1, 1),
    ("martin_luther_king_day", "US", "weekday", 1, "Mon", 3),
    ("presidents_day", "US", "weekday", 2, "Mon", 3),
    ("memorial_day", "US", "weekday", 5, "Mon", -1),
    ("independence_day", "US", "day", 7, 4),
    ("labor_day", "US", "weekday", 9, "Mon", 1),
    ("columbus_day", "US", "weekday", 10, "Mon", 2),
    ("veterans_day", "US", "day", 11, 11),
    ("thanksgiving", "US", "weekday", 11, "Thu", 4),
    ("christmas", "US", "day", 12, 25),
    ("new_year", "UK", "day", 1, 1),
    ("good_friday", "UK", "easter", -2),
    ("easter_monday", "UK", "easter", 1),
    ("early_may_holiday", "UK", "weekday", 5, "Mon", 1),
    ("spring_holiday", "UK", "weekday", 5, "Mon", -1),
    ("summer_holiday", "UK", "weekday", 8, "Mon", -1),
    ("christmas", "UK", "day", 12, 25),
    ("boxing_day", "UK", "day", 12, 26),
    ("new_year", "FR", "day", 1, 1),
    ("easter_monday", "FR", "easter", 1),
    ("may_day", "FR", "day", 5, 1),
    ("victory_day", "FR", "day", 5, 8),
    ("ascension", "FR", "easter", 39),
    ("whit_monday", "FR", "easter", 50),
    ("national_day", "FR", "day", 7, 14),
    ("assumption", "FR", "day", 8, 15),
    ("all_saints", "FR", "day", 11, 1),
    ("armistice_day", "FR", "day", 11, 11),
    ("christmas", "FR", "day", 12, 25),
)
SEPARATE_HOLIDAYS = ("new_year", "christmas", "independence_day", "thanksgiving", "labor_day", "good_friday", "easter_monday",
                     "memorial_day", "veterans_day")

# ---------------------------------------------------------------------------
# Values of the test data (see FIXTURES.md).
# ---------------------------------------------------------------------------
EPOCH_MONDAY = dt.date(1995, 1, 2)     # week number 0 of the weekly panel
# Vintages, months, plans, the panel and the clock follow the loaded days (plans/inputs.py); these are distances, not dates.
VINTAGE_STEP = 28              # days between published runs, as long as the days a run looks back
TWO_RUNS_BACK = 3              # this many vintages before the newest there is a second active run
SWITCHED_OFF_BACK = 2          # and here a run that is switched off
REPORT_DAYS_BEFORE_END = 11    # the report is read so many days before the end of the newest whole fiscal quarter
RECENT_MONTHS = 10             # accounts without a month among the last ones are not forecast
PRIVATE_FROM, PUBLIC_BELOW = 6000, 3000      # balances of accounts on private and public contracts; the rest report daily only
ACCOUNT_VINTAGES = 6           # newest weekly runs of the account forecasts

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
SEGMENT_REGIONS = ("AFRICA", "AMERICA", "MIDDLE_EAST")   # planned by region and segment
FOLDED_REGIONS = ("ASIA", "EUROPE")                      # planned as a whole
REGION_RENAME = {"ASIA": "ASIA PACIFIC"}
FOLDED_RENAMED = ("ASIA PACIFIC", "EUROPE")

# Ordered substring rules on the forecast key; the first match wins.
REGION_RULES = (
    ("%africa%", "AFRICA"),
    ("%america%", "AMERICA"),
    ("%middle_east%", "MIDDLE_EAST"),
    ("%asia%", "ASIA PACIFIC"),
    ("%europe%", "EUROPE"),
)
SEGMENT_RULES = (
    ("%automobile%", "AUTOMOBILE"),
    ("%building%", "BUILDING"),
    ("%furniture%", "FURNITURE"),
    ("%household%", "HOUSEHOLD"),
    ("%machinery%", "MACHINERY"),
    ("%all%", "All"),
)
NO_REGION, NO_SEGMENT, NO_PLATFORM, NO_SKU = "region unknown", "segment unknown", "all platforms", "all products"

# One sub-unit of one unit is forecast on its own and folded back into its parent.
CARVE_OUT_KEY = "SINGLE_1"
CARVE_OUT_PARENT = "AMERICAAUTOMOBILE"
CARVE_OUT_SEGMENT = "AUTOMOBILE"
CARVE_OUT_SUB_UNIT = "AMERICA_NATION_1"
KEY_SUFFIX = "y"

UNITS = tuple(f"{r} {s}" for r in SEGMENT_REGIONS for s in SEGMENTS) + FOLDED_REGIONS
# Snapshot keys in report order with their display names.
UNIT_ORDER = (
    tuple((r + s, f"{r} {s}") for r in SEGMENT_REGIONS for s in SEGMENTS)
    + tuple((r + "ALL", r) for r in FOLDED_REGIONS)
    + ((CARVE_OUT_KEY, "SINGLE UNIT 1"),)
)

# Growth curves per unit and cohort year: (kind, c0, c1, c2, c3, c4) over the row number.
CURVE_COHORTS = (1998, 1999, 2000, 2001)
CURVES = tuple(
    (unit, cohort) + (
        ("exponential", 2000.0 + 100.0 * i, 0.0001 * (k + 1), 0.0, 0.0, 0.0),
        ("linear", 1500.0 + 50.0 * i, 0.5 + 0.25 * k, 0.0, 0.0, 0.0),
        ("polynomial", 1000.0 + 25.0 * i, 0.5, 0.001, 0.000001, 0.0000000001),
    )[(i + k) % 3]
    for i, unit in enumerate(UNITS)
    for k, cohort in enumerate(CURVE_COHORTS)
)

# Calendar events as (name, month, day), repeated every year of the data.
EVENT_RULES = (
    ("new_year", 1, 1),
    ("spring_fair", 4, 11),
    ("midyear", 7, 1),
    ("harvest", 9, 17),
    ("year_end", 12, 31),
)
EVENT_DAYS_AROUND = 2

# Breaks of the trend that are known from outside.
GIVEN_BREAKS = (dt.date(1999, 3, 1),)
# Candidates tried per account of the monthly sources, of which there are many more than units.
ACCOUNT_SEARCH_BUDGET = 24

# Additive corrections of the target: (first day, last day, delta).
ADJUSTMENTS = (
    (dt.date(1996, 5, 6), dt.date(1996, 8, 18), 1250.0),
    (dt.date(1996, 8, 1), dt.date(1996, 10, 31), -350.0),
)

# Feature catalog of the explainer: (feature, kind, in use).
FEATURE_CATALOG = (
    ("account_balance", "account", 1),
    ("orders_total", "account", 1),
    ("mean_order_price", "account", 1),
    ("usage_a", "product", 1),
    ("usage_n", "product", 1),
    ("usage_r", "product", 1),
    ("usage_urgent", "product", 0),
    ("lag_1", "consumption", 1),
    ("lag_2", "consumption", 1),
    ("lag_3", "consumption", 1),
    ("lag_4", "consumption", 1),
)
FEATURES = tuple(name for name, _, _ in FEATURE_CATALOG)
# Coefficients of the linear attribution (one of the kinds has rows that add up to zero).
LINEAR_COEFFICIENTS = {
    "account_balance": 0.5, "orders_total": 12.0, "mean_order_price": 0.01,
    "usage_a": 0.3, "usage_n": 0.2, "usage_r": -0.1, "usage_urgent": 0.4,
    "lag_1": 0.4, "lag_2": 0.25, "lag_3": -0.05, "lag_4": 0.1,
}
CATEGORICAL_FEATURES = ("region", "sub_unit", "segment", "main_kind", "balance_band")
