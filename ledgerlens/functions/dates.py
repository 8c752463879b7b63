"""Date expressions: weekend roll, relative dates, age buckets."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = datetime.date | str

# Age limits in years of the history buckets.
AGE_LIMITS = (3, 5, 10, 15, 20)


def date_lit(value: DateLike) -> Column:
    return F.lit(str(value)).cast("date")


def weekend_roll(column: Column | str) -> Column:
    """Saturday and Sunday move back to Friday, other days stay."""
    day = F.col(column) if isinstance(column, str) else column
    weekday = F.dayofweek(day)
    back = F.when(weekday == 1, 2).when(weekday == 7, 1).otherwise(0)
    return F.date_sub(day, back)


def years_before(as_of: DateLike, years: int) -> Column:
    """The date ``years`` before ``as_of``; a constant, folded by the optimizer."""
    return F.add_months(date_lit(as_of), -12 * years)


def within_years(column: Column | str, as_of: DateLike, years: int) -> Column:
    day = F.col(column) if isinstance(column, str) else column
    return day >= years_before(as_of, years)


def age_bucket(
    column: Column | str, as_of: DateLike, limits: Sequence[int] = AGE_LIMITS
) -> Column:
    """Name of the youngest bucket that holds the date, NULL when older than all."""
    first, *rest = sorted(limits)
    bucket = F.when(within_years(column, as_of, first), f"{first}_years")
    for years in rest:
        bucket = bucket.when(within_years(column, as_of, years), f"{years}_years")
    return bucket


def bucket_years(column: Column | str) -> Column:
    """Number in front of a bucket name, for sorting."""
    name = F.col(column) if isinstance(column, str) else column
    return F.split_part(name, F.lit("_"), F.lit(1)).cast("int")


def day_gap(left: Column | str, right: Column | str) -> Column:
    """Distance between two dates in days."""
    return F.abs(F.datediff(left, right))


def year_at_most(column: Column | str, year: int) -> Column:
    return F.year(column) <= year
