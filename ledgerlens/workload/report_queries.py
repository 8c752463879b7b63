"""The nine reports over the derived tables, all companies."""

from __future__ import annotations

from ledgerlens.plans import reports
from ledgerlens.workload.registry import register, round_sql, rounded

AS_OF = "2002-01-01"
MIN_YEAR = 1996

EARN = "(ebitda - depreciationandamortization)"


def pct(top: str, bottom: str) -> str:
    return f"CAST({top} AS DOUBLE) / NULLIF(CAST({bottom} AS DOUBLE), 0) * 100.0"


METRICS = {
    "roce": pct(EARN, "totalassets - totalcurrentliabilities"),
    "interest_coverage_ratio": "CAST(operatingincome AS DOUBLE) / "
    "CASE WHEN interestexpense > 0 THEN CAST(interestexpense AS DOUBLE) END",
    "gross_margin": pct("revenue - costofrevenue", "revenue"),
    "operating_margin": pct(EARN, "revenue"),
    "cashflow_conversion": pct("operatingcashflow", "netincome"),
    "adj_fcf": "freecashflow - stockbasedcompensation",
}
METRIC_SQL = ", ".join(f"{e} AS {n}" for n, e in METRICS.items())

INT_FLOWS = [
    "ebitda", "depreciationandamortization", "operatingincome", "interestexpense", "revenue",
    "costofrevenue", "operatingcashflow", "netincome", "freecashflow", "stockbasedcompensation",
]


def ttm_sql(source: str, keys: str = "symbol") -> str:
    sums = ", ".join(f"CAST(SUM({c}) OVER w AS BIGINT) AS {c}" for c in INT_FLOWS)
    return (
        f"SELECT * REPLACE ({sums}, SUM(epsdiluted) OVER w AS epsdiluted) FROM {source} "
        f"WINDOW w AS (PARTITION BY {keys} ORDER BY date ROWS 3 PRECEDING)"
    )


CAPITAL = "totalassets - totalcurrentliabilities <> 0"


def ttm_metrics_cte(where: str = "TRUE") -> str:
    """``mq``: TTM metrics per company and quarter."""
    return f"""
picked AS (SELECT * FROM statement_quarter WHERE {CAPITAL} AND {where}),
rolled AS ({ttm_sql("picked")}),
mq AS (SELECT symbol, company_id, date, weightedaverageshsoutdil, epsdiluted, {METRIC_SQL} FROM rolled)"""


def fy_metrics_cte(where: str) -> str:
    """``mf``: fiscal-year metrics with share counts."""
    return f"""
mf AS (SELECT symbol, company_id, date, epsdiluted, numberofshares, {METRIC_SQL}
       FROM statement_fy JOIN shares_fy USING (symbol, company_id, date)
       WHERE {CAPITAL} AND {where})"""


def cagr_sql(metric: str, guard: str) -> str:
    first, last = f"arg_min({metric}, date)", f"arg_max({metric}, date)"
    return (
        f"CASE WHEN {first} > 0 AND {last} {guard} 0 THEN (POWER(CAST({last} AS DOUBLE) / "
        f"CAST({first} AS DOUBLE), 0.2) - 1) * 100 END AS {reports._cagr_name(metric)}"
    )


def summary_sql(source: str, medians, rates, guard: str, keys: str = "symbol, company_id") -> str:
    parts = [
        f"quantile_disc({x}, 0.5) AS {reports._median_name(x)}" for x in medians
    ] + [cagr_sql(x, guard) for x in rates]
    return f"SELECT {keys}, {', '.join(parts)} FROM {source} GROUP BY {keys}"


FY_OUT = [reports._median_name(x) for x in reports.FY_MEDIANS]
SCREEN_MEDIANS = [x for x in reports.FY_MEDIANS if x != "adj_fcf"]
ROUND_FY = [c for c in FY_OUT if "adj_fcf" not in c]


def rates_out(rates) -> list[str]:
    return [reports._cagr_name(x) for x in rates]


@register(
    "below_cash_value",
    """
SELECT c.symbol, companyname, sector, country, cashandcashequivalents, freecashflow, mktcap, description
FROM (SELECT * FROM balance_sheet_quarter
      QUALIFY date = MAX(date) OVER (PARTITION BY symbol)) b
JOIN cash_flow_statement_quarter f ON f.symbol = b.symbol AND f.date = b.date
JOIN company c ON c.symbol = b.symbol
WHERE cashandcashequivalents > mktcap AND longtermdebt = 0 AND sector <> 'AFRICA'
  AND isfund IS FALSE AND isetf IS FALSE AND isactivelytrading IS TRUE""",
)
def below_cash_value(t):
    return reports.below_cash_value(t, country=None, excluded_sectors=["AFRICA"])


PRESENT = """
rolled_cash AS (
  SELECT symbol, date, SUM(freecashflow) OVER w - SUM(stockbasedcompensation) OVER w AS fcf
  FROM cash_flow_statement_quarter
  WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS 3 PRECEDING)),
present AS (
  SELECT r.symbol, CAST(r.fcf AS DOUBLE) / NULLIF(s.shares * p.close, 0) * 100 AS present_adj_fcf_yield
  FROM (SELECT symbol, arg_max(fcf, date) AS fcf FROM rolled_cash GROUP BY symbol) r
  JOIN (SELECT symbol, arg_max(close, date) AS close FROM price GROUP BY symbol) p USING (symbol)
  JOIN (SELECT symbol, CAST(arg_max(weightedaverageshsoutdil, date) AS DOUBLE) AS shares
        FROM income_statement_quarter GROUP BY symbol) s USING (symbol))"""


@register(
    "current_adj_fcf_yield",
    "SELECT symbol, ROUND(present_adj_fcf_yield, 6) AS adj_fcf_yield FROM present",
    ctes=PRESENT,
)
def current_adj_fcf_yield(t):
    return rounded(reports.current_adj_fcf_yield(t, symbols=None))


@register(
    "yield_vs_history",
    """
SELECT symbol, ROUND(present_adj_fcf_yield, 6) AS present_adj_fcf_yield, range_group,
       ROUND(middle, 6) AS median_adj_fcf_yield,
       ROUND((present_adj_fcf_yield - middle) / NULLIF(middle, 0) * 100, 6)
         AS pct_present_adj_fcf_yield_change_from_median
FROM present JOIN (
  SELECT symbol, range_group, quantile_cont(y, 0.5) AS middle FROM aged
  WHERE range_group IS NOT NULL GROUP BY symbol, range_group) USING (symbol)""",
    ctes=PRESENT
    + f""",
moved AS (
  SELECT f.symbol, freecashflow, stockbasedcompensation, weightedaverageshsoutdil,
         f.date - CASE dayofweek(f.date) WHEN 0 THEN 2 WHEN 6 THEN 1 ELSE 0 END AS adj
  FROM cash_flow_statement_quarter f JOIN income_statement_quarter i USING (symbol, date)
  WHERE f.date >= DATE '{AS_OF}' - INTERVAL 20 YEAR),
yields AS (
  SELECT m.symbol, m.adj,
         CAST(SUM(freecashflow) OVER w - SUM(stockbasedcompensation) OVER w AS DOUBLE)
           / NULLIF(close * CAST(weightedaverageshsoutdil AS DOUBLE), 0) * 100 AS y
  FROM moved m JOIN price p ON p.symbol = m.symbol AND p.date = m.adj
  WINDOW w AS (PARTITION BY m.symbol ORDER BY m.adj ROWS 3 PRECEDING)),
aged AS (
  SELECT symbol, y, CASE WHEN adj >= DATE '{AS_OF}' - INTERVAL 3 YEAR THEN '3_years'
    WHEN adj >= DATE '{AS_OF}' - INTERVAL 5 YEAR THEN '5_years'
    WHEN adj >= DATE '{AS_OF}' - INTERVAL 10 YEAR THEN '10_years'
    WHEN adj >= DATE '{AS_OF}' - INTERVAL 15 YEAR THEN '15_years'
    WHEN adj >= DATE '{AS_OF}' - INTERVAL 20 YEAR THEN '20_years' END AS range_group
  FROM yields)""",
)
def yield_vs_history(t):
    return rounded(reports.yield_vs_history(t, as_of=AS_OF))


@register(
    "portfolio_fy",
    f"SELECT {round_sql([*ROUND_FY, *rates_out(reports.FY_GROWTH)])} FROM ("
    f"SELECT symbol, ceo, {', '.join([*FY_OUT, *rates_out(reports.FY_GROWTH)])} FROM ("
    + summary_sql("mf", reports.FY_MEDIANS, reports.FY_GROWTH, ">=")
    + ") JOIN (SELECT id AS company_id, ceo FROM company) USING (company_id))",
    ctes=fy_metrics_cte(f"calendaryear >= {MIN_YEAR}"),
)
def portfolio_fy(t):
    return rounded(reports.portfolio_fy(t, min_year=MIN_YEAR))


@register(
    "portfolio_ttm",
    f"SELECT {round_sql([*ROUND_FY, *rates_out(reports.TTM_GROWTH)])} FROM ("
    f"SELECT symbol, ceo, {', '.join([*FY_OUT, *rates_out(reports.TTM_GROWTH)])} FROM ("
    + summary_sql("mq", reports.FY_MEDIANS, reports.TTM_GROWTH, ">=")
    + ") JOIN (SELECT id AS company_id, ceo FROM company) USING (company_id))",
    ctes=ttm_metrics_cte(f"calendaryear >= {MIN_YEAR}"),
)
def portfolio_ttm(t):
    return rounded(reports.portfolio_ttm(t, min_year=MIN_YEAR))


NEAREST = """
near AS (
  SELECT m.symbol, m.date, p.close, p.date AS price_date
  FROM statement_quarter m LEFT JOIN price p ON p.symbol = m.symbol
  QUALIFY ROW_NUMBER() OVER (PARTITION BY m.symbol, m.date
                             ORDER BY abs(p.date - m.date), p.date) = 1)"""


@register(
    "ticker_history",
    f"""
SELECT symbol, date, ROUND(roce, 6) AS roce,
       ROUND(interest_coverage_ratio, 6) AS interest_coverage_ratio,
       ROUND(gross_margin, 6) AS gross_margin, ROUND(operating_margin, 6) AS operating_margin,
       ROUND(cashflow_conversion, 6) AS cashflow_conversion, adj_fcf,
       ROUND(epsdiluted, 6) AS epsdiluted,
       CAST(weightedaverageshsoutdil AS DOUBLE) * close AS market_cap,
       ROUND(CAST(adj_fcf AS DOUBLE)
             / NULLIF(CAST(weightedaverageshsoutdil AS DOUBLE) * close, 0) * 100, 6) AS adj_fcf_yield
FROM mq JOIN near USING (symbol, date)""",
    ctes=ttm_metrics_cte() + "," + NEAREST,
)
def ticker_history(t):
    return rounded(reports.ticker_history(t, symbols=None), skip=["market_cap"])


@register(
    "screen_median_cagr",
    f"SELECT {round_sql([*map(reports._median_name, SCREEN_MEDIANS), *rates_out(reports.FY_GROWTH)])}"
    " FROM (SELECT symbol, companyname, country, industry, ipodate, "
    f"{', '.join([*map(reports._median_name, SCREEN_MEDIANS), *rates_out(reports.FY_GROWTH)])} FROM ("
    + summary_sql("mf", SCREEN_MEDIANS, reports.FY_GROWTH, ">")
    + """) JOIN (SELECT id AS company_id, companyname, country, industry, ipodate FROM company)
      USING (company_id)
WHERE adj_fcf_cagr_last_5_years > 5 AND median_roce_last_5_years >= 10
  AND COALESCE(median_interest_coverage_ratio_last_5_years, 5) >= 5
  AND median_cashflow_conversion_last_5_years >= 95)""",
    ctes=fy_metrics_cte(f"calendaryear >= {MIN_YEAR}"),
)
def screen_median_cagr(t):
    return rounded(reports.screen_median_cagr(t, min_year=MIN_YEAR))


ROCE_METRICS = ["roce", "interest_coverage_ratio", "gross_margin", "operating_margin"]
ROCE_RATES = ["adj_fcf", "gross_margin", "operating_margin"]


@register(
    "screen_median_roce",
    f"SELECT {round_sql([*map(reports._median_name, ROCE_METRICS), *rates_out(ROCE_RATES)])} FROM ("
    + summary_sql("mz", ROCE_METRICS, ROCE_RATES, ">", keys="symbol")
    + """ HAVING """
    + " AND ".join(f"arg_min({x}, date) > 0 AND arg_max({x}, date) > 0" for x in ROCE_RATES)
    + """) WHERE adj_fcf_cagr_last_5_years > 5 AND median_roce_last_5_years >= 15
      AND median_interest_coverage_ratio_last_5_years >= 2""",
    ctes=f"""
mz AS (SELECT symbol, date, {METRICS["roce"]} AS roce,
              CAST(operatingincome AS DOUBLE) / NULLIF(interestexpense, 0) AS interest_coverage_ratio,
              {METRICS["gross_margin"]} AS gross_margin, {METRICS["operating_margin"]} AS operating_margin,
              {METRICS["adj_fcf"]} AS adj_fcf
       FROM statement_fy WHERE {CAPITAL} AND calendaryear >= {MIN_YEAR})""",
)
def screen_median_roce(t):
    return rounded(
        reports.screen_median_roce(
            t, min_year=MIN_YEAR, min_fcf_cagr=5, min_roce=15, min_coverage=2
        )
    )


@register(
    "screen_ttm_quality",
    """
SELECT a.symbol, companyname, ROUND(avg_roce, 6) AS avg_roce,
       ROUND(avg_cashflow_conversion, 6) AS avg_cashflow_conversion,
       ROUND(avg_gross_margin, 6) AS avg_gross_margin,
       ROUND(avg_operating_margin, 6) AS avg_operating_margin,
       sector, country, exchangeshortname, description
FROM (SELECT symbol, company_id, AVG(roce) AS avg_roce,
             AVG(cashflow_conversion) AS avg_cashflow_conversion,
             AVG(gross_margin) AS avg_gross_margin, AVG(operating_margin) AS avg_operating_margin
      FROM mq GROUP BY symbol, company_id) a JOIN company c ON c.id = a.company_id
WHERE avg_cashflow_conversion >= 100 AND avg_roce > 0 AND avg_roce <= 100
  AND avg_gross_margin > 0 AND avg_operating_margin > 0 AND sector NOT IN ('ASIA')
  AND year(ipodate) <= 2015 AND exchangeshortname <> 'PNK' AND isetf IS FALSE AND isfund IS FALSE""",
    ctes=ttm_metrics_cte("calendaryear > 1996"),
)
def screen_ttm_quality(t):
    return rounded(
        reports.screen_ttm_quality(t, after_year=MIN_YEAR, excluded_sectors=["ASIA"])
    )
