"""Ratio metrics as Column expressions.

All divide as double and give NULL on a zero denominator (``try_divide``), so a plan
never fails under ANSI mode.  Arguments are column names or Columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def real(value: ColumnLike) -> Column:
    """Floating-point form of a number, taken before a division."""
    return _col(value).cast("double")


def ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """numerator / denominator, NULL where the denominator is zero."""
    return F.try_divide(real(numerator), real(denominator))


def percent(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    return ratio(numerator, denominator) * F.lit(100.0)


def operating_earnings() -> Column:
    """EBITDA less depreciation and amortization."""
    return F.col("ebitda") - F.col("depreciationandamortization")


def capital_employed() -> Column:
    return F.col("totalassets") - F.col("totalcurrentliabilities")


def roce() -> Column:
    """Return on capital employed, per cent."""
    return percent(operating_earnings(), capital_employed())


def interest_coverage() -> Column:
    """Operating income over interest expense; NULL unless interest was paid."""
    paid = F.when(F.col("interestexpense") > 0, F.col("interestexpense"))
    return ratio("operatingincome", paid)


def interest_coverage_nullif() -> Column:
    """Variant that keeps negative interest expense and drops only zero."""
    return ratio("operatingincome", F.nullif(F.col("interestexpense"), F.lit(0).cast("bigint")))


def gross_margin() -> Column:
    return percent(F.col("revenue") - F.col("costofrevenue"), "revenue")


def operating_margin() -> Column:
    return percent(operating_earnings(), "revenue")


def cashflow_conversion() -> Column:
    return percent("operatingcashflow", "netincome")


def adj_fcf() -> Column:
    """Free cash flow less stock-based compensation."""
    return F.col("freecashflow") - F.col("stockbasedcompensation")


def market_cap(shares: ColumnLike, price: ColumnLike) -> Column:
    return real(shares) * real(price)


def adj_fcf_yield(fcf: ColumnLike, shares: ColumnLike, price: ColumnLike) -> Column:
    """Adjusted free cash flow over market value, per cent."""
    return percent(fcf, market_cap(shares, price))


def pct_change_from(base: ColumnLike, value: ColumnLike) -> Column:
    """Change of ``value`` against ``base``, per cent of ``base``."""
    return percent(real(value) - real(base), base)


def quality_score(roce_: ColumnLike, gross: ColumnLike, operating: ColumnLike) -> Column:
    """Sum of the three averages less the spread of the two margins."""
    g, o = _col(gross), _col(operating)
    return _col(roce_) + g + o - F.abs(g - o)


def cagr(last: ColumnLike, first: ColumnLike, years: float = 5) -> Column:
    """Compound annual growth rate, per cent, over a fixed number of years.

    Endpoints must be guarded first: a negative quotient has no real root.
    """
    return (F.pow(ratio(last, first), F.lit(1.0 / years)) - 1.0) * 100.0


def guard_nonneg(value: ColumnLike) -> Column:
    return F.when(_col(value) >= 0, _col(value))


def guard_pos(value: ColumnLike) -> Column:
    return F.when(_col(value) > 0, _col(value))


def company_metrics(*, nullif_coverage: bool = False) -> dict[str, Column]:
    """The per-period metrics shared by the reports, in report order."""
    coverage = interest_coverage_nullif() if nullif_coverage else interest_coverage()
    return {
        "roce": roce(),
        "interest_coverage_ratio": coverage,
        "gross_margin": gross_margin(),
        "operating_margin": operating_margin(),
        "cashflow_conversion": cashflow_conversion(),
        "adj_fcf": adj_fcf(),
    }
