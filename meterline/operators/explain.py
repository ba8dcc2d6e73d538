"""Forecast explainer: outlooks, features, attributions and their strength and direction.

Contributions are kept in long form, one row per (account, vintage, quarter, feature), so
shares and signs are plain aggregates over groups as small as the feature list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import fiscal
from ..functions.money import FINE, WIDE, mean_of
from .movement import NAMES

ROW = ("account_id", "train_date", "quarter_explained")


def quarter_outlook(days: DataFrame) -> DataFrame:
    """Forecast sum and week count of the current and the next fiscal quarter, in one pass.

    Accounts without a day in the current quarter are left out; a next quarter without days
    counts as zero over one week. A row is a day, or with a column ``days`` so many equal days of one quarter.
    """
    number = F.col("days") if "days" in days.columns else F.lit(1)
    run, day = fiscal.fiscal_code("run_date"), fiscal.fiscal_code("date")
    following = fiscal.fiscal_code(F.add_months("run_date", 3))
    current = run == day
    ahead = following == day

    def total(when: Column) -> Column:
        return F.sum(F.when(when, F.col("forecast") * number)).cast(WIDE)

    def count(when: Column) -> Column:
        return F.sum(F.when(when, number).otherwise(0))

    return (days.groupBy("account_id", F.col("run_date").alias("train_date"))
            .agg(count(current).alias("days_current"), total(current).alias("current_forecast"),
                 count(ahead).alias("days_next"), total(ahead).alias("next_forecast"))
            .where("days_current > 0")
            .select("account_id", "train_date", (F.col("days_current") / 7).alias("current_weeks"), "current_forecast",
                    F.coalesce("next_forecast", F.lit(0)).cast(WIDE).alias("next_forecast"),
                    F.when(F.col("days_next") > 0, F.col("days_next") / 7).otherwise(1.0).alias("next_weeks")))


def explain_features(outlook: DataFrame, panel: DataFrame, features=C.FEATURES) -> DataFrame:
    """Weekly averages of both quarters next to the panel row of the week before the train date."""
    weeks = panel.select("account_id", F.date_add("week_start", 7).alias("train_date"), "idle_12_weeks", "real", *features)
    averages = outlook.select(
        "account_id", "train_date",
        F.col("current_forecast").cast("double").alias("current_forecast"),
        (F.col("current_forecast").cast("double") / F.col("current_weeks")).alias("current_weekly_average"),
        F.col("next_forecast").cast("double").alias("next_forecast"),
        (F.col("next_forecast").cast("double") / F.col("next_weeks")).alias("next_weekly_average"))
    return averages.join(weeks, ["account_id", "train_date"])


def with_population(features: DataFrame) -> DataFrame:
    small = F.coalesce(F.col("idle_12_weeks"), F.lit(False)) | (F.col("real") == 0)
    return features.withColumn("population", F.when(small, "small").otherwise("real"))


def pending_vintages(features: DataFrame, done: DataFrame) -> DataFrame:
    """Vintages with features and without a stored result."""
    return features.select("train_date").distinct().join(done.select("train_date").distinct(), "train_date", "left_anti")


def vintage_quarter_labels(features: DataFrame) -> DataFrame:
    """Current and next quarter label of each vintage."""
    quarter = fiscal.fiscal_quarter("train_date")
    return features.select("train_date").distinct().select(
        "train_date", F.concat(F.lit("q"), quarter.cast("string")).alias("current_quarter"),
        F.concat(F.lit("q"), fiscal.next_quarter(quarter).cast("string")).alias("next_quarter"))


def linear_attribution(features: DataFrame, coefficients=None) -> DataFrame:
    """Coefficient times distance to the slice mean, per feature; slice = vintage and population.

    The base value is what the coefficients give for the slice means, so contributions plus
    base are the linear prediction. Both quarters are explained, the next one at half weight. Accounts are
    dealt before their rows are unfolded, so what groups or joins the long rows by account moves none of them.
    """
    weights = coefficients or C.LINEAR_COEFFICIENTS
    names = list(weights)
    filled = with_population(features).fillna(0, subset=names)
    slice_key = F.concat_ws("|", "train_date", "population")
    means = filled.groupBy(slice_key.alias("slice")).agg(F.struct(
        *[mean_of(F.sum(F.col(n).cast(WIDE)), F.count(F.lit(1))).cast("double").alias(n) for n in names]).alias("mean"))
    # two entries per vintage: they reach the rows as one map, so the rows are not shuffled on
    # the few slice keys
    by_slice = means.select(F.map_from_entries(F.collect_list(F.struct("slice", "mean")))).scalar()
    quarter = fiscal.fiscal_quarter("train_date")
    explained = F.array(
        F.named_struct(F.lit("label"), F.concat(F.lit("q"), quarter.cast("string")), F.lit("weight"), F.lit(1.0)),
        F.named_struct(F.lit("label"), F.concat(F.lit("q"), fiscal.next_quarter(quarter).cast("string")),
                       F.lit("weight"), F.lit(0.5)))
    spark = features.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = (filled.select("account_id", "train_date", "population", *names, slice_key.alias("slice")).repartition(tasks, "account_id")
            .withColumn("mean", F.try_element_at(by_slice, "slice"))
            .withColumn("explained", F.explode(explained)))
    base = None
    for n in names:
        part = F.lit(weights[n]) * F.col(f"mean.{n}")
        base = part if base is None else base + part
    parts = [F.struct(F.lit(n).alias("feature"), (F.lit(weights[n]) * (F.col(n) - F.col(f"mean.{n}")) * F.col("explained.weight") + 0.0).alias("contribution"))
             for n in names]
    return rows.select(
        "account_id", "train_date", F.col("explained.label").alias("quarter_explained"), "population",
        (base * F.col("explained.weight")).alias("base_value"), F.explode(F.array(*parts)).alias("part")).select(
        *ROW, "population", "base_value", "part.feature", "part.contribution")


def account_names(usage: DataFrame, private: DataFrame, public: DataFrame, latest: bool = True) -> DataFrame:
    """Account names and units from all three sources.

    By default one row per account, by its newest row; otherwise every distinct combination,
    which repeats a renamed account.
    """
    month = fiscal.month_date("year", "month").alias("date")
    rows = usage.select("account_id", *NAMES, "date")
    for source in (private, public):
        rows = rows.unionByName(source.select("account_id", *NAMES, month))
    if not latest:
        return rows.select("account_id", *NAMES).distinct()
    newest = F.max_by(F.struct(*NAMES), F.struct(F.col("date"), *NAMES)).alias("newest")
    # newest date of each combination first: a hash aggregate over the raw rows, the sorted one sees few
    dated = rows.groupBy("account_id", *NAMES).agg(F.max("date").alias("date"))
    return dated.groupBy("account_id").agg(newest).select("account_id", "newest.*")


def explainer_master(contributions: DataFrame, names: DataFrame) -> DataFrame:
    return contributions.join(names, "account_id", "left")


def features_of_kind(contributions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Contributions of the features in use, labelled with their kind."""
    used = catalog.where(F.col("in_use") == 1).select("feature", "kind")
    return contributions.join(used, "feature")


def _share(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part, whole), 9)


def _exact(c: Column) -> Column:
    return F.abs(c).cast(FINE)


def contribution_strength(labelled: DataFrame) -> DataFrame:
    """Absolute contribution over the absolute total of its kind in the row; null when that is zero."""
    kind = Window.partitionBy(*ROW, "kind")
    size = _exact(F.col("contribution"))
    return labelled.select(*ROW, "kind", "feature",
                           _share(size.cast("double"), F.sum(size).over(kind).cast("double")).alias("strength"))


def _direction(c: Column) -> Column:
    return F.when(c > 0, 1).when(c <= 0, 0)


def contribution_direction(labelled: DataFrame) -> DataFrame:
    """1 for a contribution above zero, else 0; null stays null."""
    return labelled.select(*ROW, "kind", "feature", _direction(F.col("contribution")).alias("direction"))


def kind_strength(labelled: DataFrame) -> DataFrame:
    """Share of each kind in the absolute total of the row."""
    sums = labelled.groupBy(*ROW, "kind").agg(F.sum(_exact(F.col("contribution"))).alias("size"))
    whole = F.sum("size").over(Window.partitionBy(*ROW))
    return sums.select(*ROW, "kind", _share(F.col("size").cast("double"), whole.cast("double")).alias("strength"))


def kind_direction(labelled: DataFrame) -> DataFrame:
    """Sign flag of the signed sum of each kind."""
    sums = labelled.groupBy(*ROW, "kind").agg(F.sum(F.col("contribution").cast(FINE)).alias("total"))
    return sums.select(*ROW, "kind", _direction(F.col("total")).alias("direction"))
