"""Calendar columns. Every "today" is a column or date given by the caller."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def yearmonth(d: Column) -> Column:
    """YYYYMM as an integer."""
    return F.year(d) * 100 + F.month(d)


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def month_end(d: Column) -> Column:
    return F.last_day(d)


def date_number(d: Column) -> Column:
    """YYYYMMDD as an integer."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def months_ago_yearmonth(d: Column, months: int) -> Column:
    """YYYYMM, as text, of the month `months` before d."""
    return F.date_format(F.add_months(d, -months), "yyyyMM")


def performance_year_start(d: Column, years_ago: int = 0) -> Column:
    """The first of September on or before the day `years_ago` years before d."""
    day = F.add_months(d, -12 * years_ago)
    return F.make_date(F.year(day) - (F.month(day) < 9).cast("int"), F.lit(9), F.lit(1))


def performance_year_yearmonth(d: Column, years_ago: int = 0) -> Column:
    return F.date_format(performance_year_start(d, years_ago), "yyyyMM")


def bonus_period(d: Column) -> Column:
    """YYYYMM, as text, of the month before until the seventh day, then of the month itself."""
    return F.date_format(F.when(F.dayofmonth(d) <= 7, F.add_months(d, -1)).otherwise(d), "yyyyMM")


def month_index(year: Column, month: Column) -> Column:
    """Months since year 0, so that differences are numbers of months."""
    return year * 12 + month


def last_closed_month(as_of: Column) -> Column:
    """Month index of the last month whose books are closed: a month closes on the ninth of the next."""
    d = F.add_months(as_of, -1)
    e = F.add_months(as_of, -2)
    return F.when(F.dayofmonth(as_of) > 8, month_index(F.year(d), F.month(d))).otherwise(month_index(F.year(e), F.month(e)))


def day(value: datetime.date | str) -> Column:
    return F.to_date(F.lit(str(value)))


def window_to(d: Column, as_of: Column, months: Column | int) -> Column:
    """Whether d lies in the last `months` months up to as_of, both ends included."""
    back = F.add_months(as_of, -months if isinstance(months, int) else -months)
    return d.between(back, as_of)
