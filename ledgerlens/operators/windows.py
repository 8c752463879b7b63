"""Trailing-twelve-month windows over quarterly rows.

The frame counts rows, not quarters, and a symbol's first rows are partial sums.
Statement rows are unique on (symbol, date): a partition has one row per reporting
date, some hundreds at most, however large the table is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

QUARTERS = 4

# Flow columns that are summed over four quarters.
FLOWS = (
    "ebitda",
    "depreciationandamortization",
    "operatingincome",
    "interestexpense",
    "revenue",
    "costofrevenue",
    "operatingcashflow",
    "netincome",
    "freecashflow",
    "stockbasedcompensation",
    "epsdiluted",
)


def ttm_window(keys: Sequence[str], order: str = "date", rows: int = QUARTERS) -> WindowSpec:
    return W.partitionBy(*keys).orderBy(order).rowsBetween(1 - rows, 0)


def ttm(
    df: DataFrame,
    flows: Sequence[str] = FLOWS,
    keys: Sequence[str] = ("symbol", "company_id"),
    order: str = "date",
    require_full_window: bool = False,
) -> DataFrame:
    """Replace flow columns by their four-row sums; other columns pass through.

    With ``require_full_window`` a row with fewer than four rows behind it gets NULL.
    """
    w = ttm_window(keys, order)
    sums = {c: F.sum(c).over(w) for c in flows}
    if require_full_window:
        full = F.count(F.lit(1)).over(w) == QUARTERS
        sums = {c: F.when(full, s) for c, s in sums.items()}
    return df.withColumns(sums)
