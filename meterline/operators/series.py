"""Series building: sums by key and period, future frames and model inputs.

All sums combine map-side before their shuffle, so a unit or account that holds a large
share of the rows arrives at the reducers as one row per period.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import fiscal
from ..functions.holidays import holiday
from ..functions.money import TOTAL, rounded


def daily_series(usage: DataFrame, key: str, until: dt.date | None = None) -> DataFrame:
    """Sum per key and day; without ``until`` the series runs to the last loaded date."""
    rows = usage.where(F.col("date") <= F.lit(until)) if until else usage.where(F.col("date").isNotNull())
    return rows.groupBy("date", key).agg(F.sum("dollars").cast(TOTAL).alias("dollars"))


def monthly_series(monthly: DataFrame, key: str, first: dt.date | None, last: dt.date) -> DataFrame:
    """Both monthly sources summed per key, dated at the end of the month; without ``first`` from the first month on."""
    month = fiscal.month_date("year", "month")
    return (monthly.where((month >= F.lit(first)) & (month <= F.lit(last)) if first else month <= F.lit(last))
            .groupBy(F.col(key), F.last_day(month).alias("date"))
            .agg(F.sum("dollars").cast(TOTAL).alias("dollars")))


def account_monthly_series(monthly: DataFrame, min_rows: int = C.MIN_ROWS_SERIES) -> DataFrame:
    """Monthly sums of the accounts with more than ``min_rows`` rows in one of the sources.

    Row counts travel with the sums through the first aggregation; the eligibility join then
    sees at most one row per account, source and month.
    """
    sums = monthly.groupBy("account_id", "source", "year", "month").agg(
        F.sum("dollars").alias("dollars"), F.count("*").alias("rows"))
    eligible = (sums.groupBy("account_id", "source").agg(F.sum("rows").alias("rows"))
                .where(F.col("rows") > min_rows))
    return (sums.join(eligible, "account_id", "left_semi")
            .groupBy("account_id", "year", "month").agg(F.sum("dollars").cast(TOTAL).alias("dollars")))


def future_frame_daily(series: DataFrame, key: str, horizon: int = C.DAILY_HORIZON) -> DataFrame:
    """History plus one empty row per key for each of the days after the last loaded date."""
    last = series.select(F.max("date")).scalar()
    days = F.sequence(F.date_add(last, 1), F.date_add(last, horizon))
    ahead = series.select(key).distinct().select(key, F.explode(days).alias("date"))
    return series.select(key, "date", "dollars").unionByName(ahead, allowMissingColumns=True)


def future_frame_monthly(series: DataFrame, key: str, as_of: dt.date, horizon: int = C.MONTHLY_HORIZON) -> DataFrame:
    """The same by month end, from the month of ``as_of`` on."""
    steps = F.explode(F.sequence(F.lit(0), F.lit(horizon - 1)))
    ahead = (series.select(key).distinct().select(key, steps.alias("step"))
             .select(key, F.last_day(F.add_months(F.lit(as_of), F.col("step"))).alias("date")))
    return series.select(key, "date", "dollars").unionByName(ahead, allowMissingColumns=True)


def monthly_history_end(as_of: dt.date) -> dt.date:
    """Last day of the month before ``as_of``."""
    return as_of.replace(day=1) - dt.timedelta(days=1)


WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August",
          "September", "October", "November", "December")


def _one_hot(value: Column, labels: dict[object, str], prefix: str) -> list[Column]:
    return [(value == F.lit(v)).cast("int").alias(f"{prefix}_{label}") for v, label in labels.items()]


def _target(test_start: dt.date) -> Column:
    return F.when(F.col("date") < F.lit(test_start), F.col("dollars")).alias("dollars")


def calendar_regressors_daily(frame: DataFrame, key: str, test_start: dt.date) -> DataFrame:
    """One-hot calendar columns; the target is null from the start of the test part on."""
    d = F.col("date")
    month_first = fiscal.month_start(d) == d
    month_last = F.last_day(d) == d
    flags = {
        "is_month_start": month_first,
        "is_month_end": month_last,
        "is_quarter_start": month_first & (F.month(d) % 3 == 1),
        "is_quarter_end": month_last & (F.month(d) % 3 == 0),
    }
    return frame.select(
        key, "date", _target(test_start),
        *_one_hot(F.dayofweek(d), {i + 1: n for i, n in enumerate(WEEKDAYS)}, "day"),
        *_one_hot(F.month(d), {i + 1: n for i, n in enumerate(MONTHS)}, "month"),
        *_one_hot(F.quarter(d), {q: str(q) for q in range(1, 5)}, "quarter"),
        *_one_hot(F.weekofyear(d), {w: str(w) for w in range(1, 54)}, "week"),
        *[c for name, flag in flags.items() for c in (flag.cast("int").alias(f"{name}_True"),
                                                      (~flag).cast("int").alias(f"{name}_False"))])


def calendar_regressors_monthly(frame: DataFrame, key: str, test_start: dt.date) -> DataFrame:
    d = F.col("date")
    return frame.select(
        key, "date", _target(test_start),
        *_one_hot(F.month(d), {i + 1: n for i, n in enumerate(MONTHS)}, "month"),
        *_one_hot(F.quarter(d), {q: str(q) for q in range(1, 5)}, "quarter"))


def growth_curve_features(series: DataFrame, curves: DataFrame, cohorts=C.CURVE_COHORTS) -> DataFrame:
    """Configured growth curve of each cohort year over the unit's row number."""
    n = F.col("row_number").cast("double")

    def value(cohort: int) -> Column:
        c = F.col(f"curve_{cohort}")
        polynomial = c.c0 + n * (c.c1 + n * (c.c2 + n * (c.c3 + n * c.c4)))
        return rounded(F.when(c.shape == "exponential", c.c0 * F.exp(c.c1 * n))
                       .when(c.shape == "linear", c.c0 + c.c1 * n)
                       .when(c.shape == "polynomial", polynomial)).alias(f"growth_{cohort}")

    by_date = Window.partitionBy("unit").orderBy("date")
    return (series.withColumn("row_number", F.row_number().over(by_date))
            .join(curves, "unit", "left")
            .select("unit", "date", "dollars", "row_number", *[value(y) for y in cohorts]))


def event_days(series: DataFrame, rules=C.EVENT_RULES, around: int = C.EVENT_DAYS_AROUND) -> DataFrame:
    """One row per day near an event, with a 0/1 column per event name."""
    years = series.select(F.sequence(F.year(F.min("date")) - 1, F.year(F.max("date")) + 1).alias("years"))
    listed = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(m).alias("month"), F.lit(d).alias("day"))
                       for n, m, d in rules])
    dated = (years.select(F.explode("years").alias("year"))
             .select("year", F.explode(listed).alias("event"))
             .select(F.col("event.name").alias("name"), F.make_date("year", "event.month", "event.day").alias("on")))
    near = dated.select("name", F.explode(F.sequence(F.date_sub("on", around), F.date_add("on", around))).alias("date"))
    return near.groupBy("date").agg(*[F.max((F.col("name") == n).cast("int")).alias(f"event_{n}") for n, _, _ in rules])


def event_regressors(series: DataFrame, key: str, rules=C.EVENT_RULES, around: int = C.EVENT_DAYS_AROUND) -> DataFrame:
    flags = [f"event_{n}" for n, _, _ in rules]
    return (series.join(event_days(series, rules, around), "date", "left")
            .select(key, "date", "dollars", *[F.coalesce(F.col(f), F.lit(0)).alias(f) for f in flags]))


def holiday_days(frame: DataFrame, rules=C.HOLIDAY_RULES, apart: tuple[str, ...] = C.SEPARATE_HOLIDAYS,
                 around: int = C.HOLIDAY_DAYS_AROUND) -> DataFrame:
    """date, term, offset: the holidays of the years of a frame and the days around them.

    ``term`` is the name of a holiday listed in ``apart``, else ``other_holiday``; ``offset`` counts the days from the holiday.
    The same holiday of several countries is one.
    """
    years = frame.select(F.sequence(F.year(F.min("date")) - 1, F.year(F.max("date")) + 1).alias("years"))
    dated = F.array(*[F.struct(F.lit(name if name in apart else "other_holiday").alias("term"), holiday(F.col("year"), rule, *given).alias("on"))
                      for name, _, rule, *given in rules])
    days = years.select(F.explode("years").alias("year")).select(F.explode(dated).alias("h"))
    days = days.select("h.term", "h.on", F.explode(F.sequence(F.lit(-around), F.lit(around))).alias("offset"))
    return days.select(F.date_add("on", F.col("offset")).alias("date"), "term", "offset").distinct()


def holiday_regressors(frame: DataFrame, key: str, apart: tuple[str, ...] = C.SEPARATE_HOLIDAYS, around: int = C.HOLIDAY_DAYS_AROUND) -> DataFrame:
    """A 0/1 column for each holiday (and the others together) and each day around it, over history and horizon alike."""
    name = lambda term, k: f"{term}_{'minus' if k < 0 else 'plus'}_{abs(k)}" if k else term
    columns = [(t, k) for t in (*apart, "other_holiday") for k in range(-around, around + 1)]
    flags = holiday_days(frame, apart=apart, around=around).groupBy("date").agg(
        *[F.max(((F.col("term") == t) & (F.col("offset") == k)).cast("int")).alias(name(t, k)) for t, k in columns])
    return frame.join(flags, "date", "left").select(key, "date", "dollars", *[F.coalesce(F.col(name(t, k)), F.lit(0)).alias(name(t, k)) for t, k in columns])


def lag_features(series: DataFrame, key: str, lags: tuple[int, ...], mean_lags: tuple[int, int], grain: str = "day") -> DataFrame:
    """Single lags and the mean over a range of lags, in days or months of the calendar.

    A lag is null where the series has no row that far back; missing days or months shift nothing.
    """
    at = F.datediff("date", F.lit(dt.date(1970, 1, 1))) if grain == "day" else F.year("date") * 12 + F.month("date")
    ordered = Window.partitionBy(key).orderBy("at")
    nearest, farthest = mean_lags
    frame = ordered.rangeBetween(-farthest, -nearest)
    averaged = F.sum("dollars").over(frame).cast("double") / F.count("dollars").over(frame)
    return series.withColumn("at", at).select(
        key, "date", "dollars",
        *[F.sum("dollars").over(ordered.rangeBetween(-k, -k)).cast(TOTAL).alias(f"lag_{k}") for k in lags],
        rounded(averaged).alias("mean_lag"))


def adjustment_days(adjustments: DataFrame) -> DataFrame:
    """Ranges to days; overlapping ranges add up."""
    days = adjustments.select(F.explode(F.sequence("first_day", "last_day")).alias("date"), "delta")
    return days.groupBy("date").agg(F.sum("delta").alias("delta"))


def anomaly_adjustment(series: DataFrame, key: str, adjustments: DataFrame) -> DataFrame:
    """Add the delta of every range a day falls into. The range join is an equi join on days."""
    delta = F.coalesce(F.col("delta"), F.lit(0)).cast(TOTAL)
    return (series.join(adjustment_days(adjustments), "date", "left")
            .select(key, "date", "dollars", (F.col("dollars") + delta).alias("adjusted")))


def source_ready(source: DataFrame, name: str, as_of: dt.date) -> DataFrame:
    """Whether the month before ``as_of`` has rows; the month filter reaches the scan."""
    before = F.add_months(F.lit(as_of), -1)
    return (source.where((F.col("year") == F.year(before)) & (F.col("month") == F.month(before)))
            .agg((F.count("*") > 0).alias("ready")).select(F.lit(name).alias("source"), "ready"))
