"""The nine investment reports.

Each takes ``tables`` (stored table name to DataFrame) and returns a DataFrame.
Thresholds, symbols and years are parameters with the customary values as defaults.
Descending orders put NULL first.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import metrics as m
from ledgerlens.functions.dates import (
    DateLike,
    age_bucket,
    bucket_years,
    within_years,
    years_before,
    year_at_most,
)
from ledgerlens.operators import asof, growth, statements, windows

Tables = Mapping[str, DataFrame]
Symbols = Collection[str] | DataFrame | None

INCOME = (
    "ebitda",
    "depreciationandamortization",
    "operatingincome",
    "interestexpense",
    "revenue",
    "costofrevenue",
    "netincome",
    "epsdiluted",
)
BALANCE = ("totalassets", "totalcurrentliabilities")
CASH_FLOW = ("operatingcashflow", "freecashflow", "stockbasedcompensation")
KEYS = statements.STATEMENT_KEYS
COMPANY_KEYS = ("symbol", "company_id")


def _median_name(metric: str) -> str:
    return f"median_{metric}_last_5_years"


def _cagr_name(metric: str) -> str:
    # Output names end in "years" for these three and in "year" otherwise.
    plural = metric in ("adj_fcf", "gross_margin", "operating_margin")
    return f"{metric}_cagr_last_5_year" + ("s" if plural else "")


def ordered(df: DataFrame, *order: Column | str) -> DataFrame:
    """A report's rows in total order.

    Sorting range-partitions, and to find the ranges Spark first runs what lies below
    once more.  The exchange in between makes that a read of the finished rows, which
    are few, instead of a second run of scans, joins and windows.  It spreads by all
    columns; by symbol alone it would count as done already and be left out.
    """
    return df.repartition(*df.columns).orderBy(*order)


def statement_base(
    tables: Tables,
    period: str,
    symbols: Symbols = None,
    year_filter: Column | None = None,
    extra_income: Sequence[str] = (),
) -> DataFrame:
    """The three statements joined, restricted to rows with capital employed.

    Symbol and year filters go to every side: the keys are equal, and so each scan
    reads only what it needs.  They precede any window, as the reports want it.
    """

    def side(stem: str, columns: Sequence[str]) -> DataFrame:
        df = statements.keep_symbols(tables[f"{stem}_{period}"], symbols)
        if year_filter is not None:
            df = df.filter(year_filter)
        return df.select(*KEYS, *columns)

    joined = statements.join_statements(
        side("income_statement", [*INCOME, *extra_income]),
        side("balance_sheet", BALANCE),
        side("cash_flow_statement", CASH_FLOW),
    )
    return joined.filter(statements.has_capital())


def quarterly_metrics(
    base: DataFrame, require_full_window: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """TTM sums turned into the metrics, per company and quarter."""
    summed = windows.ttm(base, keys=COMPANY_KEYS, require_full_window=require_full_window)
    named = [c.alias(n) for n, c in m.company_metrics().items()]
    return summed.select(*KEYS, *named, "epsdiluted", *keep)


def below_cash_value(
    tables: Tables,
    country: str | None = "US",
    excluded_sectors: Collection[str] = ("Financial Services",),
    long_term_debt: int = 0,
) -> DataFrame:
    """Companies whose latest balance sheet holds more cash than their market value."""
    balance = statements.latest_rows(
        tables["balance_sheet_quarter"].select(
            "symbol", "date", "cashandcashequivalents", "longtermdebt"
        )
    ).filter(F.col("longtermdebt") == long_term_debt)
    cash_flow = tables["cash_flow_statement_quarter"].select("symbol", "date", "freecashflow")
    company = tables["company"].filter(
        F.col("isfund").eqNullSafe(False)
        & F.col("isetf").eqNullSafe(False)
        & F.col("isactivelytrading").eqNullSafe(True)
    )
    if country is not None:
        company = company.filter(F.col("country") == country)
    for sector in excluded_sectors:
        company = company.filter(F.col("sector") != sector)
    company = company.select("symbol", "companyname", "sector", "country", "mktcap", "description")
    return (
        balance.join(company, "symbol")
        .filter(F.col("cashandcashequivalents") > F.col("mktcap"))
        .join(cash_flow, ["symbol", "date"])
        .select(
            "symbol",
            "companyname",
            "sector",
            "country",
            "cashandcashequivalents",
            "freecashflow",
            "mktcap",
            "description",
        )
        .transform(ordered, F.desc_nulls_first("mktcap"))
    )


def present_yield(tables: Tables, symbols: Symbols = None) -> DataFrame:
    """Latest TTM adjusted free cash flow over latest price times latest share count."""
    flows = ("freecashflow", "stockbasedcompensation")
    cash = statements.keep_symbols(tables["cash_flow_statement_quarter"], symbols)
    summed = windows.ttm(cash.select("symbol", "date", *flows), flows=flows, keys=("symbol",))
    fcf = statements.latest_values(summed.withColumn("fcf", m.adj_fcf()), ["fcf"])
    prices = statements.keep_symbols(tables["price"], symbols)
    shares = statements.keep_symbols(tables["income_statement_quarter"], symbols)
    return (
        fcf.join(statements.latest_values(prices, ["close"]), "symbol")
        .join(statements.latest_values(shares, ["weightedaverageshsoutdil"]), "symbol")
        .select(
            "symbol",
            m.adj_fcf_yield("fcf", "weightedaverageshsoutdil", "close").alias("adj_fcf_yield"),
        )
    )


def current_adj_fcf_yield(tables: Tables, symbols: Symbols = ("ADBE",)) -> DataFrame:
    """Present adjusted free-cash-flow yield per symbol."""
    return present_yield(tables, symbols)


def yield_history(
    tables: Tables, as_of: DateLike, symbols: Symbols = None, look_back: int = 20
) -> DataFrame:
    """Yield at each past quarter that has a price on its weekend-adjusted date.

    The window runs after the price join: a quarter without a price is not part of
    any later frame.
    """
    cash = statements.keep_symbols(tables["cash_flow_statement_quarter"], symbols)
    cash = cash.filter(within_years("date", as_of, look_back))
    income = statements.keep_symbols(tables["income_statement_quarter"], symbols)
    price = statements.keep_symbols(tables["price"], symbols)
    # A statement looks for its price at most two days before its date.
    price = price.filter(F.col("date") >= F.date_sub(years_before(as_of, look_back), 3))
    joined = cash.select(*KEYS, "freecashflow", "stockbasedcompensation").join(
        income.select(*KEYS, "weightedaverageshsoutdil"), list(KEYS)
    )
    priced = asof.exact_price(joined, price)
    flows = ("freecashflow", "stockbasedcompensation")
    summed = windows.ttm(priced, flows=flows, keys=("symbol",), order="adj_date")
    return summed.select(
        "symbol",
        F.col("adj_date").alias("date"),
        m.adj_fcf_yield(m.adj_fcf(), "weightedaverageshsoutdil", "close").alias("adj_fcf_yield"),
    )


def yield_vs_history(
    tables: Tables, as_of: DateLike, symbols: Symbols = None, look_back: int = 20
) -> DataFrame:
    """Present yield against the median yield of each age bucket."""
    medians = (
        yield_history(tables, as_of, symbols, look_back)
        .withColumn("range_group", age_bucket("date", as_of))
        .filter(F.col("range_group").isNotNull())
        .groupBy("symbol", "range_group")
        .agg(growth.median_cont("adj_fcf_yield").alias("median_adj_fcf_yield"))
    )
    present = present_yield(tables, symbols).withColumnRenamed(
        "adj_fcf_yield", "present_adj_fcf_yield"
    )
    change = m.pct_change_from("median_adj_fcf_yield", "present_adj_fcf_yield")
    return (
        medians.join(present, "symbol")
        .select(
            "symbol",
            "present_adj_fcf_yield",
            "range_group",
            "median_adj_fcf_yield",
            change.alias("pct_present_adj_fcf_yield_change_from_median"),
        )
        .transform(ordered, "symbol", bucket_years("range_group"))
    )


FY_MEDIANS = (
    "roce",
    "interest_coverage_ratio",
    "gross_margin",
    "operating_margin",
    "cashflow_conversion",
    "adj_fcf",
)
TTM_GROWTH = ("adj_fcf", "gross_margin", "operating_margin", "cashflow_conversion", "epsdiluted")
FY_GROWTH = (*TTM_GROWTH, "numberofshares")


def yearly_metrics(tables: Tables, symbols: Symbols, min_year: int) -> DataFrame:
    """Fiscal-year metrics with the share count."""
    base = statement_base(tables, "fy", symbols, F.col("calendaryear") >= min_year)
    named = [c.alias(n) for n, c in m.company_metrics().items()]
    shares = tables["shares_fy"]
    if "symbol" in shares.columns:
        shares = statements.keep_symbols(shares, symbols)
    return statements.join_shares(base, shares).select(
        *KEYS, *named, "epsdiluted", "numberofshares"
    )


def _growth_summary(
    metrics: DataFrame,
    medians: Sequence[str],
    rates: Sequence[str],
    years: float,
    guard,
) -> DataFrame:
    summary = growth.summarise(metrics, COMPANY_KEYS, medians, rates)
    return growth.add_cagr(summary, {x: _cagr_name(x) for x in rates}, years, guard).select(
        *COMPANY_KEYS,
        *[F.col(f"median_{x}").alias(_median_name(x)) for x in medians],
        *[_cagr_name(x) for x in rates],
    )


def portfolio_fy(
    tables: Tables, symbols: Symbols = None, min_year: int = 2018, years: float = 5
) -> DataFrame:
    """Fiscal-year medians and growth rates of a portfolio, share count included."""
    summary = _growth_summary(
        yearly_metrics(tables, symbols, min_year), FY_MEDIANS, FY_GROWTH, years, m.guard_nonneg
    )
    return (
        statements.join_company(summary, tables["company"], ["ceo"])
        .select(
            "symbol",
            "ceo",
            *[_median_name(x) for x in FY_MEDIANS],
            *[_cagr_name(x) for x in FY_GROWTH],
        )
        .transform(ordered, F.desc_nulls_first(_median_name("roce")))
    )


def portfolio_ttm(
    tables: Tables,
    symbols: Symbols = None,
    min_year: int = 2018,
    years: float = 5,
    require_full_window: bool = False,
) -> DataFrame:
    """Trailing-twelve-month medians and growth rates of a portfolio."""
    base = statement_base(tables, "quarter", symbols, F.col("calendaryear") >= min_year)
    summary = _growth_summary(
        quarterly_metrics(base, require_full_window), FY_MEDIANS, TTM_GROWTH, years, m.guard_nonneg
    )
    return (
        statements.join_company(summary, tables["company"], ["ceo"])
        .select(
            "symbol",
            "ceo",
            *[_median_name(x) for x in FY_MEDIANS],
            *[_cagr_name(x) for x in TTM_GROWTH],
        )
        .transform(ordered, F.desc_nulls_first(_median_name("gross_margin")))
    )


def ticker_history(
    tables: Tables, symbols: Symbols = ("MSFT",), require_full_window: bool = False
) -> DataFrame:
    """TTM metrics of every quarter with market value and yield at the nearest price."""
    shares = "weightedaverageshsoutdil"
    base = statement_base(tables, "quarter", symbols, extra_income=[shares])
    metrics = quarterly_metrics(base, require_full_window, keep=[shares])
    prices = statements.keep_symbols(tables["price"], symbols)
    return (
        asof.nearest_price(metrics, prices)
        .select(
            "symbol",
            "date",
            *[n for n in m.company_metrics()],
            "epsdiluted",
            m.market_cap(shares, "close").alias("market_cap"),
            m.adj_fcf_yield("adj_fcf", shares, "close").alias("adj_fcf_yield"),
        )
        .transform(ordered, "symbol", "date")
    )


def screen_median_cagr(
    tables: Tables,
    symbols: Symbols = None,
    min_year: int = 2018,
    years: float = 5,
    min_fcf_cagr: float = 5,
    min_roce: float = 10,
    min_coverage: float = 5,
    min_conversion: float = 95,
) -> DataFrame:
    """Companies with growing adjusted free cash flow and good fiscal-year medians."""
    medians = [x for x in FY_MEDIANS if x != "adj_fcf"]
    summary = _growth_summary(
        yearly_metrics(tables, symbols, min_year), medians, FY_GROWTH, years, m.guard_pos
    )
    coverage = F.col(_median_name("interest_coverage_ratio"))
    passed = summary.filter(
        (F.col(_cagr_name("adj_fcf")) > min_fcf_cagr)
        & (F.col(_median_name("roce")) >= min_roce)
        & (coverage.isNull() | (coverage >= min_coverage))
        & (F.col(_median_name("cashflow_conversion")) >= min_conversion)
    )
    about = ["companyname", "country", "industry", "ipodate"]
    return (
        statements.join_company(passed, tables["company"], about)
        .select(
            "symbol",
            *about,
            *[_median_name(x) for x in medians],
            *[_cagr_name(x) for x in FY_GROWTH],
        )
        .transform(ordered, F.desc_nulls_first(_median_name("roce")))
    )


def screen_median_roce(
    tables: Tables,
    symbols: Symbols = None,
    min_year: int = 2018,
    years: float = 5,
    min_fcf_cagr: float = 15,
    min_roce: float = 20,
    min_coverage: float = 10,
) -> DataFrame:
    """Companies by median return on capital whose endpoints are all positive."""
    base = statement_base(tables, "fy", symbols, F.col("calendaryear") >= min_year)
    wanted = ("roce", "interest_coverage_ratio", "gross_margin", "operating_margin", "adj_fcf")
    exprs = m.company_metrics(nullif_coverage=True)
    metrics = base.select("symbol", "date", *[exprs[x].alias(x) for x in wanted])
    rates = ("adj_fcf", "gross_margin", "operating_margin")
    medians = [x for x in wanted if x != "adj_fcf"]
    summary = growth.summarise(metrics, ["symbol"], medians, rates).filter(
        growth.endpoints_positive(rates)
    )
    rated = growth.add_cagr(summary, {x: _cagr_name(x) for x in rates}, years)
    return (
        rated.select(
            "symbol",
            *[F.col(f"median_{x}").alias(_median_name(x)) for x in medians],
            *[_cagr_name(x) for x in rates],
        )
        .filter(
            (F.col(_cagr_name("adj_fcf")) > min_fcf_cagr)
            & (F.col(_median_name("roce")) >= min_roce)
            & (F.col(_median_name("interest_coverage_ratio")) >= min_coverage)
        )
        .transform(ordered, F.desc_nulls_first(_median_name("roce")))
    )


def screen_ttm_quality(
    tables: Tables,
    symbols: Symbols = None,
    after_year: int = 2018,
    min_conversion: float = 100,
    excluded_sectors: Collection[str] = ("Financial Services", "Real Estate"),
    excluded_exchange: str = "PNK",
    max_ipo_year: int = 2015,
    max_roce: float = 100,
) -> DataFrame:
    """Companies by average TTM quality, best composite score first."""
    base = statement_base(tables, "quarter", symbols, F.col("calendaryear") > after_year)
    names = ("roce", "cashflow_conversion", "gross_margin", "operating_margin")
    averages = (
        quarterly_metrics(base)
        .groupBy(*COMPANY_KEYS)
        .agg(*[F.avg(x).alias(f"avg_{x}") for x in names])
        .filter(
            (F.col("avg_cashflow_conversion") >= min_conversion)
            & (F.col("avg_roce") > 0)
            & (F.col("avg_roce") <= max_roce)
            & (F.col("avg_gross_margin") > 0)
            & (F.col("avg_operating_margin") > 0)
        )
    )
    company = tables["company"].filter(
        year_at_most("ipodate", max_ipo_year)
        & (F.col("exchangeshortname") != excluded_exchange)
        & F.col("isetf").eqNullSafe(False)
        & F.col("isfund").eqNullSafe(False)
    )
    for sector in excluded_sectors:
        company = company.filter(F.col("sector") != sector)
    about = ["companyname", "sector", "country", "exchangeshortname", "description"]
    score = m.quality_score("avg_roce", "avg_gross_margin", "avg_operating_margin")
    return (
        statements.join_company(averages, company, about)
        .select(
            "symbol",
            "companyname",
            *[f"avg_{x}" for x in names],
            "sector",
            "country",
            "exchangeshortname",
            "description",
        )
        .transform(ordered, score.desc_nulls_first())
    )
