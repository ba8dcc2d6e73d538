"""Fiscal calendar as column expressions.

The fiscal year starts on 1 February and carries the name of the year it ends in, so
moving a date 11 months ahead turns fiscal years and quarters into calendar ones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fiscal_year(c: Column | str) -> Column:
    return F.year(F.add_months(_col(c), 11))


def fiscal_quarter(c: Column | str) -> Column:
    return F.quarter(F.add_months(_col(c), 11))


def fiscal_code(c: Column | str) -> Column:
    """Fiscal year and quarter as one number, ``yyyyqq``."""
    shifted = F.add_months(_col(c), 11)
    return (F.year(shifted) * 100 + F.quarter(shifted)).cast("int")


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "month")


def month_date(year: Column | str, month: Column | str) -> Column:
    return F.make_date(_col(year), _col(month), F.lit(1))


def quarter_start(c: Column | str) -> Column:
    return F.add_months(F.trunc(F.add_months(_col(c), -1), "quarter"), 1)


def quarter_end(c: Column | str) -> Column:
    return F.last_day(F.add_months(quarter_start(c), 2))


def monday_of(c: Column | str) -> Column:
    return F.trunc(_col(c), "week")


def next_quarter(quarter: Column) -> Column:
    return F.pmod(quarter, F.lit(4)) + 1


def next_quarter_year(quarter: Column, year: Column) -> Column:
    return F.when(quarter == 4, year + 1).otherwise(year)


def last_closed_month(as_of: Column | str, close_day: int) -> Column:
    """Month start of the last month whose monthly actuals are in at ``as_of``."""
    d = _col(as_of)
    back = F.when(F.dayofmonth(d) <= close_day, F.lit(-2)).otherwise(F.lit(-1))
    return F.add_months(F.trunc(d, "month"), back)


def monthly_vintage_for(as_of: Column | str, close_day: int) -> Column:
    """Monthly vintage to use at ``as_of``: the month after the last closed one."""
    return F.add_months(last_closed_month(as_of, close_day), 1)
