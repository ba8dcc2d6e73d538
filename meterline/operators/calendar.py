"""Calendar operators: fiscal labels, quarter bounds, cut-off dates and date spines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import fiscal


def with_fiscal_code(df: DataFrame, date: str, name: str = "fiscal_code") -> DataFrame:
    return df.withColumn(name, fiscal.fiscal_code(date))


def with_quarter_bounds(df: DataFrame, date: str) -> DataFrame:
    return df.select("*", fiscal.quarter_start(date).alias("quarter_start"), fiscal.quarter_end(date).alias("quarter_end"))


def with_fiscal_parts(df: DataFrame, date: str, prefix: str) -> DataFrame:
    """Fiscal quarter (1-4) and fiscal year of a date as two columns."""
    return df.select("*", fiscal.fiscal_quarter(date).alias(f"{prefix}_quarter"),
                     fiscal.fiscal_year(date).alias(f"{prefix}_year"))


def with_next_quarter(df: DataFrame, date: str) -> DataFrame:
    """Current and next fiscal quarter, as numbers and as labels ``q1`` to ``q4``."""
    quarter, year = fiscal.fiscal_quarter(date), fiscal.fiscal_year(date)
    following = fiscal.next_quarter(quarter)

    def label(q: Column) -> Column:
        return F.concat(F.lit("q"), q.cast("string"))

    return df.select(
        "*", quarter.alias("quarter"), year.alias("year"), following.cast("int").alias("next_quarter"),
        fiscal.next_quarter_year(quarter, year).alias("next_year"),
        label(quarter).alias("quarter_label"), label(following).alias("next_quarter_label"))


def with_monthly_cutoffs(df: DataFrame, date: str, close_day: int = C.CLOSE_DAY) -> DataFrame:
    """Last month with complete monthly actuals, and the monthly vintage to read."""
    return df.select("*", fiscal.last_closed_month(date, close_day).alias("last_actual_month"),
                     fiscal.monthly_vintage_for(date, close_day).alias("monthly_vintage"))


def calendar_spine(df: DataFrame, key: str, date: str, step: str = "1 day") -> DataFrame:
    """One row per key and day (or month) from the key's first to its last date."""
    ends = df.groupBy(key).agg(F.min(date).alias("first"), F.max(date).alias("last"))
    first = fiscal.month_start("first") if "month" in step else F.col("first")
    return ends.select(key, F.explode(F.sequence(first, F.col("last"), F.expr(f"interval {step}"))).alias(date))
