"""Exact money arithmetic.

Amounts stay ``decimal(18,4)`` through every sum, so a total does not depend on the order
in which partitions arrive; means are taken once, on the exact sum.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AMOUNT = "decimal(18,4)"   # one usage row
TOTAL = "decimal(28,4)"    # sums of them
WIDE = "decimal(28,6)"     # means
FINE = "decimal(30,9)"     # contributions: weight times a mean


def mean_of(total: Column, rows: Column) -> Column:
    return (total.cast("double") / rows).cast(WIDE)


def mean(c: str) -> Column:
    return mean_of(F.sum(c), F.count(c))


def scaled(total: Column, numerator: Column | int, denominator: Column | int) -> Column:
    """``total * numerator / denominator`` cut (not rounded) at four decimals.

    Works in whole ten-thousandths, so there is no tie to round.
    """
    def whole(n: Column | int) -> Column:
        return (n if isinstance(n, Column) else F.lit(n)).cast("decimal(10,0)")

    units = F.call_function("div", F.floor(total * 10000) * whole(numerator), whole(denominator))
    return (units.cast("decimal(20,0)") * F.lit(Decimal("0.0001"))).cast(TOTAL)


def as_doubles(df: DataFrame) -> DataFrame:
    """Turn every decimal column to double, at the edge of a query only."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
        for f in df.schema.fields
    ])


def rounded(c: Column, digits: int = 6) -> Column:
    """Round a quotient; adding zero turns a negative zero to zero."""
    return F.round(c, digits) + F.lit(0.0)
