"""Series forecasting: model terms as tables, splits, metrics and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import terms as X
from ..functions.money import TOTAL, rounded, scaled

# --- terms as tables ---------------------------------------------------------------------


def _span(key: str) -> tuple[Column, Column]:
    """First and last observed date of a series, next to each of its rows."""
    whole = Window.partitionBy(key)
    observed = F.when(F.col("dollars").isNotNull(), F.col("date"))
    return F.min("date").over(whole), F.max(observed).over(whole)


def growth_terms(frame: DataFrame, key: str) -> DataFrame:
    first, _ = _span(key)
    t = X.years_since(F.col("first"), F.col("date"))
    return frame.withColumn("first", first).select(
        key, "date", "dollars", *[rounded(c).alias(n) for n, c in X.growth_terms(t).items()])


def seasonal_terms(frame: DataFrame, key: str, seasons=X.DAILY_SEASONS) -> DataFrame:
    return frame.select(key, "date", "dollars",
                        *[rounded(c).alias(n) for n, c in X.seasonal_terms(F.col("date"), seasons).items()])


def changepoint_terms(frame: DataFrame, key: str, count: int) -> DataFrame:
    """Evenly spaced trend breaks over the observed part: years passed since each of them."""
    first, last = _span(key)
    spanned = frame.select("*", first.alias("first"), last.alias("last"))
    breaks = X.break_dates(F.col("first"), F.col("last"), count)
    return spanned.select(key, "date", "dollars", *[
        rounded(X.years_after(F.col("date"), b)).alias(f"break_{i}") for i, b in enumerate(breaks, 1)])


def detected_changepoints(series: DataFrame, key: str, bucket_days: int = 30, strength: float = 0.5,
                          min_distance: int = 2, quiet_end: float = 0.1) -> DataFrame:
    """Dates at which the trend of the bucketed series turns most.

    The score of a bucket is the change of slope around it. A break is kept when its score
    reaches ``strength`` of the largest one, no bucket closer than ``min_distance`` scores
    higher (the earlier one wins a tie) and it is not in the last ``quiet_end`` share.
    """
    whole = Window.partitionBy(key)
    ordered = whole.orderBy("bucket")
    bucket = F.floor(F.datediff("date", F.min("date").over(whole)) / F.lit(bucket_days)).cast("int")
    sums = (series.select(key, "date", "dollars", F.min("date").over(whole).alias("first"), bucket.alias("bucket"))
            .groupBy(key, "first", "bucket").agg(F.sum("dollars").alias("amount")))
    turn = F.lead("amount").over(ordered) - 2 * F.col("amount") + F.lag("amount").over(ordered)
    scored = (sums.select("*", turn.alias("turn"), F.max("bucket").over(whole).alias("last_bucket"))
              .where(F.col("turn").isNotNull()).withColumn("score", F.abs("turn")))
    before = F.max("score").over(ordered.rangeBetween(-min_distance, -1))
    after = F.max("score").over(ordered.rangeBetween(1, min_distance))
    peaks = scored.select("*", F.max("score").over(whole).alias("top"), before.alias("before"), after.alias("after"))
    kept = ((F.col("score").cast("double") >= F.col("top").cast("double") * strength)
            & (F.col("score") > F.coalesce("before", F.lit(-1)))
            & (F.col("score") >= F.coalesce("after", F.lit(-1)))
            & (F.col("bucket") <= F.col("last_bucket") * (1 - quiet_end)))
    return peaks.where(kept).select(
        key, F.expr(f"date_add(first, bucket * {bucket_days})").alias("break_date"), "turn")


# --- splits and metrics ------------------------------------------------------------------


def rolling_origin_splits(series: DataFrame, key: str, horizon: int, spacing: int, unit: str = "day",
                          max_splits: int = C.MAX_SPLITS) -> DataFrame:
    """Label rows train or test for the most recent expanding-window splits.

    A row is emitted once per split it belongs to, at most ``max_splits`` times; there is no
    join with a split table.
    """
    last = F.max("date").over(Window.partitionBy(key))

    def back(n: Column) -> Column:
        if unit == "day":
            return F.date_sub(F.col("last"), n)
        return F.last_day(F.add_months(F.col("last"), -n))

    step = F.col("split")
    cut, end = back(step * spacing), back(step * spacing - horizon)
    return (series.select(key, "date", "dollars", last.alias("last"),
                          F.explode(F.sequence(F.lit(1), F.lit(max_splits))).alias("split"))
            .select(key, "date", "dollars", "split", cut.alias("cut"), end.alias("end"))
            .where(F.col("date") <= F.col("end"))
            .select(key, "date", "dollars", "split", "cut",
                    F.when(F.col("date") <= F.col("cut"), "train").otherwise("test").alias("part")))


def forecast_metrics(rows: DataFrame, keys: list[str], block: Column,
                     tolerance: float = C.RELATIVE_TOLERANCE) -> DataFrame:
    """Errors of ``forecast`` against ``actual`` after summing both over a block of periods.

    Both sides are summed as decimals, so a block does not depend on the order of rows.
    """
    blocks = rows.groupBy(*keys, block.alias("block")).agg(
        F.sum("actual").cast(TOTAL).alias("a"), F.sum("forecast").cast(TOTAL).alias("f"))
    error = F.abs(F.col("a") - F.col("f")).cast(TOTAL)
    blocks = blocks.select("*", error.alias("e"), F.col("a").cast("double").alias("ad"),
                           F.col("f").cast("double").alias("fd"), error.cast("double").alias("ed"))
    total = F.abs("ad") + F.abs("fd")
    return blocks.groupBy(*keys).agg(
        F.count("*").alias("blocks"),
        F.round(F.sqrt(F.sum(F.col("ed") * F.col("ed")) / F.count("*")), 4).alias("rmse"),
        F.round(F.sum("e").cast("double") / F.count("*"), 4).alias("mae"),
        F.round(F.avg(F.try_divide("ed", F.abs("ad"))) * 100, 6).alias("mape"),
        F.round(F.avg(F.try_divide(2 * F.col("ed"), total)) * 100, 6).alias("smape"),
        F.round(F.avg((F.col("ed") > tolerance * F.abs("ad")).cast("double")), 6).alias("share_outside"))


def window_mean_scores(series: DataFrame, key: str, windows: tuple[int, ...], horizon: int,
                       periods: int = C.METRIC_PERIODS_DAILY) -> DataFrame:
    """Score the mean of the last n days as a forecast on each rolling-origin split.

    Gives one row per series, split, window and block of days: the exact sums of actuals and
    forecasts, for the train days next to the cut and for the test days.
    """
    labelled = rolling_origin_splits(series, key, horizon, horizon)
    day = F.datediff("date", "cut")
    near = labelled.where(day > -max(*windows, horizon)).select("*", day.alias("day"))
    levels = near.groupBy(key, "split").agg(F.array(*[
        F.struct(F.lit(w).alias("window"),
                 F.sum(F.when(F.col("day").between(1 - w, 0), F.col("dollars"))).cast(TOTAL).alias("total"))
        for w in windows]).alias("levels"))
    # train days run backwards from the cut, so that both parts have blocks of equal length
    position = F.when(F.col("part") == "train", -F.col("day")).otherwise(F.col("day") - 1)
    blocks = (near.where(F.col("day") > -horizon)
              .groupBy(key, "split", "part", F.floor(position / periods).cast("int").alias("block"))
              .agg(F.sum("dollars").cast(TOTAL).alias("actual")))
    days = F.least(F.lit(periods), horizon - F.col("block") * periods)
    forecast = scaled(F.col("level.total"), days, F.col("level.window"))
    return (blocks.join(levels, [key, "split"]).withColumn("level", F.explode("levels"))
            .select(key, "split", "part", "block", F.col("level.window").alias("window"), "actual",
                    forecast.alias("forecast")))


def search_summary(scores: DataFrame, key: str, splits: int = C.MAX_SPLITS) -> DataFrame:
    """Rank, mean and per-split score of each candidate of each series."""
    table = scores.groupBy(key, "candidate").agg(
        F.round(F.sum("score").cast("double") / F.count("score"), 8).alias("mean_score"),
        F.sum("fit_rows").alias("fit_rows"),
        *[F.max(F.when(F.col("split") == k, F.col("score"))).alias(f"split_{k}") for k in range(1, splits + 1)])
    return table.withColumn("rank", F.rank().over(Window.partitionBy(key).orderBy("mean_score")))


def backtest_summary(metrics: DataFrame, key: str, names: tuple[str, ...]) -> DataFrame:
    """Train and test value of each metric side by side."""
    long = metrics.unpivot([key, "part"], list(names), "metric", "value")
    return long.groupBy(key, "metric").agg(
        *[F.max(F.when(F.col("part") == p, F.col("value"))).alias(p) for p in ("train", "test")])


def completeness_check(forecast: DataFrame, series: str, run: list[str], horizon: int, expected: DataFrame) -> DataFrame:
    """Rows expected and found per run.

    ``expected`` lists the series a run has to have (column ``series``). It comes from outside, so a series that is lost
    from all runs is missed; rows of other series do not count.
    """
    known = expected.select(series).distinct()
    rows = forecast.join(known.withColumn("known", F.col(series)), series, "left")
    n = known.select(F.count("*")).scalar()
    counted = rows.groupBy(*run).agg(F.count("known").alias("found"), F.count_distinct("known").alias("kinds"))
    return counted.select(
        *run, (n * horizon).alias("expected"), "found", ((F.col("found") == n * horizon) & (F.col("kinds") == n)).alias("complete"))


def require_complete(checked: DataFrame) -> None:
    """Stop a job when any run is incomplete."""
    if not checked.where(~F.col("complete")).isEmpty():
        raise ValueError("forecast rows are missing for at least one run")
