"""Scalar functions and metric expressions over all statement rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions import dates, values
from ledgerlens.functions import metrics as m
from ledgerlens.operators import growth, statements
from ledgerlens.workload.registry import register, round_sql, rounded
from ledgerlens.workload.report_queries import METRICS, pct

KEY = ("symbol", "date")


def _joined(t, period="quarter"):
    return statements.join_statements(
        t[f"income_statement_{period}"],
        t[f"balance_sheet_{period}"],
        t[f"cash_flow_statement_{period}"],
    )


def _metric(name, column, sql):
    """A query of one metric over the joined quarterly statements."""

    @register(name, f"SELECT symbol, date, {sql} AS {name} FROM statement_quarter")
    def query(t):
        return _joined(t).select(*KEY, column().alias(name))


_metric("roce", m.roce, METRICS["roce"])
_metric("interest_coverage", m.interest_coverage, METRICS["interest_coverage_ratio"])
_metric(
    "interest_coverage_nullif",
    m.interest_coverage_nullif,
    "CAST(operatingincome AS DOUBLE) / NULLIF(interestexpense, 0)",
)
_metric("gross_margin", m.gross_margin, METRICS["gross_margin"])
_metric("operating_margin", m.operating_margin, METRICS["operating_margin"])
_metric("cashflow_conversion", m.cashflow_conversion, METRICS["cashflow_conversion"])
_metric("adj_fcf", m.adj_fcf, METRICS["adj_fcf"])
_metric("cast_real", lambda: m.real("revenue"), "CAST(revenue AS DOUBLE)")
_metric(
    "nullif",
    lambda: F.nullif(F.col("interestexpense"), F.lit(0).cast("bigint")),
    "NULLIF(interestexpense, 0)",
)
_metric("round4", lambda: F.round("epsdiluted", values.COMPARE_DECIMALS), "ROUND(epsdiluted, 4)")
_metric("extract_year", lambda: F.year("date"), "CAST(EXTRACT(YEAR FROM date) AS INTEGER)")
_metric("weekend_roll", lambda: dates.weekend_roll("date"),
        "date - CASE dayofweek(date) WHEN 0 THEN 2 WHEN 6 THEN 1 ELSE 0 END")
BUCKET_AS_OF = "2010-01-01"
BUCKET_SQL = f"""CASE WHEN date >= DATE '{BUCKET_AS_OF}' - INTERVAL 3 YEAR THEN '3_years'
  WHEN date >= DATE '{BUCKET_AS_OF}' - INTERVAL 5 YEAR THEN '5_years'
  WHEN date >= DATE '{BUCKET_AS_OF}' - INTERVAL 10 YEAR THEN '10_years'
  WHEN date >= DATE '{BUCKET_AS_OF}' - INTERVAL 15 YEAR THEN '15_years'
  WHEN date >= DATE '{BUCKET_AS_OF}' - INTERVAL 20 YEAR THEN '20_years' END"""
_metric("range_bucket", lambda: dates.age_bucket("date", BUCKET_AS_OF), BUCKET_SQL)
_metric(
    "split_part_int",
    lambda: dates.bucket_years(dates.age_bucket("date", BUCKET_AS_OF)),
    f"CAST(split_part({BUCKET_SQL}, '_', 1) AS INTEGER)",
)


@register(
    "market_cap",
    """SELECT symbol, date, CAST(weightedaverageshsoutdil AS DOUBLE) * close AS market_cap
       FROM statement_quarter JOIN price USING (symbol, date)""",
)
def market_cap(t):
    joined = t["income_statement_quarter"].join(t["price"].select(*KEY, "close"), list(KEY))
    return joined.select(*KEY, m.market_cap("weightedaverageshsoutdil", "close").alias("market_cap"))


@register(
    "adj_fcf_yield",
    """SELECT symbol, date, ROUND(CAST(freecashflow - stockbasedcompensation AS DOUBLE)
         / NULLIF(CAST(weightedaverageshsoutdil AS DOUBLE) * close, 0) * 100, 6) AS adj_fcf_yield
       FROM statement_quarter JOIN price USING (symbol, date)""",
)
def adj_fcf_yield(t):
    joined = _joined(t).join(t["price"].select(*KEY, "close"), list(KEY))
    return rounded(
        joined.select(
            *KEY,
            m.adj_fcf_yield(m.adj_fcf(), "weightedaverageshsoutdil", "close").alias("adj_fcf_yield"),
        )
    )


def _ends(t):
    return growth.summarise(
        _joined(t, "fy").withColumn("adj_fcf", m.adj_fcf()),
        ["symbol"],
        endpoints=["adj_fcf", "revenue"],
    )


ENDS = """
ends AS (SELECT symbol, arg_min(adj, date) AS first_adj, arg_max(adj, date) AS last_adj,
                arg_min(revenue, date) AS first_revenue, arg_max(revenue, date) AS last_revenue
         FROM (SELECT *, freecashflow - stockbasedcompensation AS adj FROM statement_fy)
         GROUP BY symbol)"""
RATE = "(POWER(CAST({0} AS DOUBLE) / CAST({1} AS DOUBLE), 0.2) - 1) * 100"


@register(
    "cagr",
    f"SELECT symbol, ROUND({RATE.format('last_revenue', 'first_revenue')}, 6) AS cagr FROM ends",
    ctes=ENDS,
)
def cagr(t):
    return rounded(_ends(t).select("symbol", m.cagr("last_revenue", "first_revenue").alias("cagr")))


@register(
    "cagr_guard_nonneg",
    f"""SELECT symbol, ROUND(CASE WHEN first_adj > 0 AND last_adj >= 0
          THEN {RATE.format("last_adj", "first_adj")} END, 6) AS cagr FROM ends""",
    ctes=ENDS,
)
def cagr_guard_nonneg(t):
    rated = growth.add_cagr(_ends(t), {"adj_fcf": "cagr"}, guard=m.guard_nonneg)
    return rounded(rated.select("symbol", "cagr"))


@register(
    "cagr_guard_pos",
    f"""SELECT symbol, ROUND(CASE WHEN first_adj > 0 AND last_adj > 0
          THEN {RATE.format("last_adj", "first_adj")} END, 6) AS cagr FROM ends""",
    ctes=ENDS,
)
def cagr_guard_pos(t):
    return rounded(growth.add_cagr(_ends(t), {"adj_fcf": "cagr"}).select("symbol", "cagr"))


@register(
    "cagr_guard_filter",
    f"""SELECT symbol, ROUND({RATE.format("last_adj", "first_adj")}, 6) AS cagr FROM
        (SELECT * FROM ends WHERE LEAST(first_adj, last_adj) > 0)""",
    ctes=ENDS,
)
def cagr_guard_filter(t):
    kept = _ends(t).filter(growth.endpoints_positive(["adj_fcf"]))
    return rounded(growth.add_cagr(kept, {"adj_fcf": "cagr"}).select("symbol", "cagr"))


@register(
    "pct_change_from_median",
    """SELECT symbol, date, ROUND((CAST(revenue AS DOUBLE) - middle) / NULLIF(middle, 0) * 100, 6)
         AS pct_change_from_median
       FROM statement_quarter JOIN (
         SELECT symbol, quantile_cont(CAST(revenue AS DOUBLE), 0.5) AS middle
         FROM statement_quarter GROUP BY symbol) USING (symbol)""",
)
def pct_change_from_median(t):
    income = t["income_statement_quarter"].select(*KEY, "revenue")
    middle = income.groupBy("symbol").agg(growth.median_cont("revenue").alias("middle"))
    change = m.pct_change_from("middle", "revenue").alias("pct_change_from_median")
    return rounded(income.join(middle, "symbol").select(*KEY, change))


@register(
    "quality_score",
    f"""SELECT symbol, ROUND(r + g + o - ABS(g - o), 6) AS quality_score FROM (
          SELECT symbol, AVG({METRICS["roce"]}) AS r, AVG({METRICS["gross_margin"]}) AS g,
                 AVG({METRICS["operating_margin"]}) AS o FROM statement_fy GROUP BY symbol)""",
)
def quality_score(t):
    averages = _joined(t, "fy").groupBy("symbol").agg(
        F.avg(m.roce()).alias("r"),
        F.avg(m.gross_margin()).alias("g"),
        F.avg(m.operating_margin()).alias("o"),
    )
    return rounded(averages.select("symbol", m.quality_score("r", "g", "o").alias("quality_score")))


@register(
    "abs_date_gap",
    """SELECT s.symbol, s.date, CAST(ABS(s.date - c.ipodate) AS INTEGER) AS gap_days
       FROM statement_quarter s JOIN company c ON c.symbol = s.symbol""",
)
def abs_date_gap(t):
    listed = t["company"].select("symbol", "ipodate")
    joined = t["income_statement_quarter"].select(*KEY).join(listed, "symbol")
    return joined.select(*KEY, dates.day_gap("date", "ipodate").alias("gap_days"))


@register(
    "coalesce",
    """SELECT o.symbol, o.date, COALESCE(n.interestexpense, o.interestexpense) AS interestexpense
       FROM snapshot_old o JOIN snapshot_new n USING (symbol, date)""",
    snapshots=True,
)
def coalesce(t):
    new = t["snapshot_new"].select(*KEY, F.col("interestexpense").alias("given"))
    joined = t["snapshot_old"].select(*KEY, "interestexpense").join(new, list(KEY))
    return joined.select(
        *KEY, F.coalesce("given", "interestexpense").alias("interestexpense")
    )


@register("upper_trim", "SELECT id, symbol, upper(companyname) AS companyname FROM company")
def upper_trim(t):
    loose = t["company"].select(
        "id",
        F.concat(F.lit("  "), F.lower("symbol"), F.lit(" ")).alias("symbol"),
        F.concat(F.lit(" "), F.lower("companyname")).alias("companyname"),
    )
    return loose.select(
        "id",
        values.clean_ticker("symbol").alias("symbol"),
        values.clean_ticker("companyname").alias("companyname"),
    )


@register(
    "interval_arith",
    """SELECT symbol, date, CAST(date - INTERVAL 2 DAY AS DATE) AS two_days_before,
              CAST(date - INTERVAL 3 YEAR AS DATE) AS three_years_before FROM price""",
)
def interval_arith(t):
    return t["price"].select(
        *KEY,
        F.date_sub("date", 2).alias("two_days_before"),
        F.add_months("date", -36).alias("three_years_before"),
    )
