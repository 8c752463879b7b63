"""Medians, first and last values and growth rates per company, in one aggregate."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.metrics import cagr, guard_pos


def median_disc(column: str) -> Column:
    """The lower middle value that occurs in the data."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{column}`)")


def median_cont(column: str) -> Column:
    """The interpolated middle value."""
    return F.percentile(F.col(column).cast("double"), F.lit(0.5))


def summarise(
    df: DataFrame,
    keys: Sequence[str],
    medians: Sequence[str] = (),
    endpoints: Sequence[str] = (),
    order: str = "date",
) -> DataFrame:
    """Medians (``median_x``) and values at the first and last date (``first_x``, ``last_x``).

    One grouping serves both, in place of a minimum/maximum date aggregate joined
    back twice.  Needs unique (keys, order).
    """
    return df.groupBy(*keys).agg(
        *[median_disc(c).cast(df.schema[c].dataType).alias(f"median_{c}") for c in medians],
        *[F.min_by(c, order).alias(f"first_{c}") for c in endpoints],
        *[F.max_by(c, order).alias(f"last_{c}") for c in endpoints],
    )


def add_cagr(
    df: DataFrame,
    columns: Mapping[str, str],
    years: float = 5,
    guard: Callable[[str], Column] = guard_pos,
) -> DataFrame:
    """Growth rate of each metric between its guarded endpoints.

    ``columns`` maps metric to output name.  The exponent is fixed by ``years``
    whatever the dates span.
    """
    return df.withColumns(
        {
            out: cagr(guard(f"last_{metric}"), guard(f"first_{metric}"), years)
            for metric, out in columns.items()
        }
    )


def endpoints_positive(metrics: Sequence[str]) -> Column:
    """Both endpoints of every metric are above zero."""
    test = F.lit(True)
    for metric in metrics:
        test = test & (F.col(f"first_{metric}") > 0) & (F.col(f"last_{metric}") > 0)
    return test
