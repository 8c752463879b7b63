"""Projections, filters, joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlens.functions import dates
from ledgerlens.functions import metrics as m
from ledgerlens.operators import asof, growth, manifest, statements, windows
from ledgerlens.workload.registry import register, round_sql, rounded
from ledgerlens.workload.report_queries import METRICS, NEAREST, ttm_sql

KEY = ("symbol", "date")
AS_OF = "2002-01-01"


# --- projections and filters -------------------------------------------------------------


@register(
    "proj_columns",
    "SELECT symbol, date AS reported, revenue AS sales, netincome AS profit FROM statement_quarter",
)
def proj_columns(t):
    return t["income_statement_quarter"].select(
        "symbol",
        F.col("date").alias("reported"),
        F.col("revenue").alias("sales"),
        F.col("netincome").alias("profit"),
    )


@register(
    "proj_star_join",
    "SELECT b.*, c.* EXCLUDE (symbol) FROM balance_sheet_fy b JOIN company c ON c.symbol = b.symbol",
)
def proj_star_join(t):
    b, c = t["balance_sheet_fy"].alias("b"), t["company"].alias("c")
    return b.join(c, F.col("b.symbol") == F.col("c.symbol")).select("b.*", "c.*").drop(c["symbol"])


@register(
    "filter_compare",
    """SELECT symbol, date, revenue FROM statement_quarter
       WHERE totalassets - totalcurrentliabilities <> 0 AND calendaryear >= 1996
         AND netincome > 0 AND period = 'Q1'""",
)
def filter_compare(t):
    return (
        statements.join_statements(
            t["income_statement_quarter"],
            t["balance_sheet_quarter"],
            t["cash_flow_statement_quarter"],
        )
        .filter(
            statements.has_capital()
            & (F.col("calendaryear") >= 1996)
            & (F.col("netincome") > 0)
            & (F.col("period") == "Q1")
        )
        .select(*KEY, "revenue")
    )


@register(
    "filter_in_list",
    "SELECT symbol, companyname, sector FROM company WHERE sector IN ('ASIA', 'EUROPE')",
)
def filter_in_list(t):
    listed = t["company"].filter(F.col("sector").isin("ASIA", "EUROPE"))
    return listed.select("symbol", "companyname", "sector")


@register(
    "filter_bool_is",
    """SELECT symbol, isetf, isfund, isactivelytrading FROM company
       WHERE isetf IS FALSE AND isfund IS FALSE AND isactivelytrading IS TRUE""",
)
def filter_bool_is(t):
    return t["company"].filter(
        F.col("isetf").eqNullSafe(False)
        & F.col("isfund").eqNullSafe(False)
        & F.col("isactivelytrading").eqNullSafe(True)
    ).select("symbol", "isetf", "isfund", "isactivelytrading")


@register(
    "filter_null_or",
    """SELECT symbol, date, interestexpense FROM snapshot_new
       WHERE interestexpense IS NULL OR interestexpense >= 500000000""",
    snapshots=True,
)
def filter_null_or(t):
    expense = F.col("interestexpense")
    return t["snapshot_new"].filter(expense.isNull() | (expense >= 500000000)).select(
        *KEY, "interestexpense"
    )


@register(
    "filter_not_equal",
    "SELECT symbol, sector, isetf FROM company WHERE sector <> 'ASIA' AND isetf <> TRUE",
)
def filter_not_equal(t):
    kept = t["company"].filter((F.col("sector") != "ASIA") & (F.col("isetf") != F.lit(True)))
    return kept.select("symbol", "sector", "isetf")


@register(
    "filter_cross_table",
    """SELECT b.symbol, b.date, cashandcashequivalents, mktcap FROM balance_sheet_quarter b
       JOIN company c ON c.id = b.company_id WHERE cashandcashequivalents > mktcap""",
)
def filter_cross_table(t):
    joined = statements.join_company(t["balance_sheet_quarter"], t["company"], ["mktcap"])
    return joined.filter(F.col("cashandcashequivalents") > F.col("mktcap")).select(
        *KEY, "cashandcashequivalents", "mktcap"
    )


@register(
    "filter_relative_date",
    f"""SELECT symbol, date, close FROM price
        WHERE date >= DATE '{AS_OF}' - INTERVAL 3 YEAR""",
)
def filter_relative_date(t):
    return t["price"].filter(dates.within_years("date", AS_OF, 3)).select(*KEY, "close")


@register(
    "filter_year",
    """SELECT c.symbol, ipodate, date FROM company c JOIN statement_fy s ON s.symbol = c.symbol
       WHERE year(ipodate) <= 2015 AND calendaryear > 1996""",
)
def filter_year(t):
    listed = t["company"].filter(dates.year_at_most("ipodate", 2015)).select("symbol", "ipodate")
    recent = t["income_statement_fy"].filter(F.col("calendaryear") > 1996).select(*KEY)
    return listed.join(recent, "symbol").select("symbol", "ipodate", "date")


@register(
    "case_expr",
    """SELECT symbol, date, CASE WHEN netincome <= 0 THEN 'loss'
         WHEN netincome < 1000000000 THEN 'small' ELSE 'large' END AS size,
         CASE WHEN freecashflow >= 0 THEN freecashflow ELSE NULL END AS positive_fcf
       FROM statement_quarter""",
)
def case_expr(t):
    income = F.col("netincome")
    size = F.when(income <= 0, "loss").when(income < 1000000000, "small").otherwise("large")
    return t["cash_flow_statement_quarter"].select(
        *KEY, size.alias("size"), m.guard_nonneg("freecashflow").alias("positive_fcf")
    )


@register(
    "inline_array_table",
    """SELECT w.sector, c.symbol FROM (SELECT unnest(['AFRICA', 'ASIA']) AS sector) w
       JOIN company c ON c.sector = w.sector""",
)
def inline_array_table(t):
    company = t["company"]
    wanted = company.sparkSession.range(1).select(
        F.explode(F.array(F.lit("AFRICA"), F.lit("ASIA"))).alias("sector")
    )
    return wanted.join(company.select("sector", "symbol"), "sector")


@register(
    "cte",
    """, margins AS (SELECT symbol, date, revenue - costofrevenue AS gross FROM statement_quarter),
    tops AS (SELECT symbol, MAX(gross) AS top FROM margins GROUP BY symbol)
    SELECT symbol, date, gross, gross = top AS is_top FROM margins JOIN tops USING (symbol)""",
)
def cte(t):
    margins = t["income_statement_quarter"].select(
        *KEY, (F.col("revenue") - F.col("costofrevenue")).alias("gross")
    )
    tops = margins.groupBy("symbol").agg(F.max("gross").alias("top"))
    return margins.join(tops, "symbol").select(
        *KEY, "gross", (F.col("gross") == F.col("top")).alias("is_top")
    )


# --- joins -------------------------------------------------------------------------------


@register(
    "join_statements",
    """SELECT i.symbol, i.company_id, i.date, i.revenue, b.totalassets, c.freecashflow
       FROM income_statement_quarter i JOIN balance_sheet_quarter b USING (company_id, date)
       JOIN cash_flow_statement_quarter c USING (company_id, date)""",
)
def join_statements(t):
    return statements.join_statements(
        t["income_statement_quarter"],
        t["balance_sheet_quarter"],
        t["cash_flow_statement_quarter"],
    ).select("symbol", "company_id", "date", "revenue", "totalassets", "freecashflow")


@register(
    "join_shares",
    """SELECT i.symbol, i.date, i.netincome, numberofshares FROM income_statement_fy i
       JOIN shares_fy s ON s.company_id = i.company_id AND s.date = i.date""",
)
def join_shares(t):
    joined = statements.join_shares(t["income_statement_fy"], t["shares_fy"])
    return joined.select(*KEY, "netincome", "numberofshares")


@register(
    "join_dim",
    """SELECT i.symbol, date, revenue, companyname, sector, country
       FROM income_statement_quarter i JOIN company c ON c.id = i.company_id""",
)
def join_dim(t):
    about = ["companyname", "sector", "country"]
    joined = statements.join_company(t["income_statement_quarter"], t["company"], about)
    return joined.select(*KEY, "revenue", *about)


@register(
    "join_implicit",
    """SELECT b.symbol, b.date, totalassets, freecashflow, companyname, close
       FROM balance_sheet_quarter b, cash_flow_statement_quarter f, company c, price p
       WHERE b.symbol = f.symbol AND b.date = f.date AND c.symbol = b.symbol
         AND p.symbol = b.symbol AND p.date = b.date""",
)
def join_implicit(t):
    return (
        t["balance_sheet_quarter"]
        .select(*KEY, "totalassets")
        .join(t["cash_flow_statement_quarter"].select(*KEY, "freecashflow"), list(KEY))
        .join(t["price"].select(*KEY, "close"), list(KEY))
        .join(t["company"].select("symbol", "companyname"), "symbol")
    )


@register(
    "join_cross_scalar",
    """SELECT last_date, companies, total_revenue FROM (SELECT MAX(date) AS last_date FROM price),
       (SELECT COUNT(*) AS companies FROM company),
       (SELECT CAST(SUM(revenue) AS BIGINT) AS total_revenue FROM statement_fy)""",
)
def join_cross_scalar(t):
    # Each side is a global aggregate, so one row: a scalar subquery, not a cross join.
    companies = t["company"].agg(F.count("*"))
    revenue = t["income_statement_fy"].agg(F.sum("revenue"))
    return t["price"].agg(F.max("date").alias("last_date")).select(
        "last_date",
        companies.scalar().alias("companies"),
        revenue.scalar().alias("total_revenue"),
    )


def _fy_median(t):
    return t["income_statement_fy"].groupBy("symbol").agg(
        growth.median_disc("revenue").cast("bigint").alias("median_revenue")
    )


@register(
    "join_right_inner",
    """SELECT o.symbol, median_revenue, companyname FROM
       (SELECT symbol, quantile_disc(revenue, 0.5) AS median_revenue FROM statement_fy GROUP BY symbol) m
       RIGHT JOIN (SELECT DISTINCT symbol FROM snapshot_old) o ON o.symbol = m.symbol
       JOIN company c ON c.symbol = m.symbol""",
    snapshots=True,
)
def join_right_inner(t):
    stored = t["snapshot_old"].select("symbol").distinct()
    names = t["company"].select("symbol", "companyname")
    return _fy_median(t).join(stored, "symbol", "right").join(names, "symbol")


@register(
    "join_left_filter",
    """SELECT m.symbol, median_revenue, profits FROM
       (SELECT symbol, quantile_disc(revenue, 0.5) AS median_revenue FROM statement_fy GROUP BY symbol) m
       LEFT JOIN (SELECT symbol, CAST(SUM(netincome) AS BIGINT) AS profits FROM snapshot_old
                  GROUP BY symbol) o USING (symbol) WHERE profits > 30000000000""",
    snapshots=True,
)
def join_left_filter(t):
    profits = t["snapshot_old"].groupBy("symbol").agg(F.sum("netincome").alias("profits"))
    return _fy_median(t).join(profits, "symbol", "left").filter("profits > 30000000000")


@register(
    "join_left",
    """SELECT symbol, date, n.revenue AS new_revenue, o.revenue AS old_revenue
       FROM snapshot_new n LEFT JOIN snapshot_old o USING (symbol, date)""",
    snapshots=True,
)
def join_left(t):
    old = t["snapshot_old"].select(*KEY, F.col("revenue").alias("old_revenue"))
    new = t["snapshot_new"].select(*KEY, F.col("revenue").alias("new_revenue"))
    return new.join(old, list(KEY), "left")


@register(
    "join_semi_symbols",
    """SELECT symbol, date, close FROM price
       WHERE symbol IN (SELECT symbol FROM company WHERE sector = 'ASIA')""",
)
def join_semi_symbols(t):
    asia = t["company"].filter("sector = 'ASIA'").select("symbol")
    # listed twice: a semi join does not repeat rows
    return statements.keep_symbols(t["price"].select(*KEY, "close"), asia.unionByName(asia))


@register(
    "join_anti",
    """SELECT symbol, date, revenue FROM snapshot_new
       WHERE (symbol, date) NOT IN (SELECT (symbol, date) FROM snapshot_old)""",
    snapshots=True,
)
def join_anti(t):
    new = t["snapshot_new"].select(*KEY, "revenue")
    return new.join(t["snapshot_old"].select(*KEY), list(KEY), "left_anti")


@register(
    "join_latest_row",
    """SELECT b.symbol, b.date, cashandcashequivalents, longtermdebt FROM balance_sheet_quarter b
       JOIN (SELECT symbol, MAX(date) AS date FROM balance_sheet_quarter GROUP BY symbol) l
         ON l.symbol = b.symbol AND l.date = b.date""",
)
def join_latest_row(t):
    return statements.latest_rows(
        t["balance_sheet_quarter"].select(*KEY, "cashandcashequivalents", "longtermdebt")
    )


@register(
    "join_minmax_row",
    """SELECT f.symbol, f.revenue AS first_revenue, l.revenue AS last_revenue FROM
       (SELECT symbol, MIN(date) AS a, MAX(date) AS z FROM statement_quarter GROUP BY symbol) r
       JOIN statement_quarter f ON f.symbol = r.symbol AND f.date = r.a
       JOIN statement_quarter l ON l.symbol = r.symbol AND l.date = r.z""",
)
def join_minmax_row(t):
    return growth.summarise(t["income_statement_quarter"], ["symbol"], endpoints=["revenue"])


@register(
    "join_asof_nearest",
    "SELECT symbol, date, price_date, close FROM near",
    ctes=NEAREST,
)
def join_asof_nearest(t):
    return asof.nearest_price(t["income_statement_quarter"].select(*KEY), t["price"])


@register(
    "join_exact_price",
    """SELECT s.symbol, s.date, p.date AS adj_date, p.close FROM statement_quarter s JOIN price p
       ON p.symbol = s.symbol
      AND p.date = s.date - CASE dayofweek(s.date) WHEN 0 THEN 2 WHEN 6 THEN 1 ELSE 0 END""",
)
def join_exact_price(t):
    return asof.exact_price(t["income_statement_quarter"].select(*KEY), t["price"]).select(
        *KEY, "adj_date", "close"
    )


@register(
    "join_scalar_lookup",
    """SELECT symbol, date, (SELECT c.id FROM company c WHERE c.symbol = p.symbol) AS company_id
       FROM price p""",
)
def join_scalar_lookup(t):
    ids = t["company"].select("symbol", F.col("id").alias("company_id"))
    return t["price"].select(*KEY).join(ids, "symbol", "left")


@register(
    "join_bucket_present",
    """SELECT symbol, period, middle, latest FROM
       (SELECT symbol, period, quantile_cont(CAST(revenue AS DOUBLE), 0.5) AS middle
        FROM statement_quarter GROUP BY symbol, period)
       JOIN (SELECT symbol, arg_max(revenue, date) AS latest FROM statement_quarter GROUP BY symbol)
       USING (symbol)""",
)
def join_bucket_present(t):
    income = t["income_statement_quarter"]
    medians = income.groupBy("symbol", "period").agg(growth.median_cont("revenue").alias("middle"))
    latest = statements.latest_values(income, ["revenue"])
    return medians.join(latest.withColumnRenamed("revenue", "latest"), "symbol")


# --- aggregates --------------------------------------------------------------------------


@register("agg_max_date", "SELECT symbol, MAX(date) AS date FROM price GROUP BY symbol")
def agg_max_date(t):
    return t["price"].groupBy("symbol").agg(F.max("date").alias("date"))


@register(
    "agg_minmax_date",
    """SELECT company_id, MIN(date) AS min_date, MAX(date) AS max_date
       FROM statement_quarter GROUP BY company_id""",
)
def agg_minmax_date(t):
    return t["income_statement_quarter"].groupBy("company_id").agg(
        F.min("date").alias("min_date"), F.max("date").alias("max_date")
    )


AVERAGES = {
    "avg_roce": METRICS["roce"],
    "avg_coverage": METRICS["interest_coverage_ratio"],
    "avg_gross_margin": METRICS["gross_margin"],
    "avg_operating_margin": METRICS["operating_margin"],
}
AVG_SQL = ", ".join(f"ROUND(AVG({e}), 6) AS {n}" for n, e in AVERAGES.items())


def _averages(t):
    joined = statements.join_statements(
        t["income_statement_quarter"],
        t["balance_sheet_quarter"],
        t["cash_flow_statement_quarter"],
    )
    exprs = [m.roce(), m.interest_coverage(), m.gross_margin(), m.operating_margin()]
    return joined.groupBy("symbol", "company_id").agg(
        *[F.avg(e).alias(n) for n, e in zip(AVERAGES, exprs)]
    )


@register(
    "agg_avg",
    f"SELECT symbol, company_id, {AVG_SQL} FROM statement_quarter GROUP BY symbol, company_id",
)
def agg_avg(t):
    return rounded(_averages(t))


@register(
    "agg_having",
    f"""SELECT symbol, company_id, {AVG_SQL} FROM statement_quarter GROUP BY symbol, company_id
        HAVING AVG({METRICS["gross_margin"]}) >= 45""",
)
def agg_having(t):
    return rounded(_averages(t).filter("avg_gross_margin >= 45"))


@register(
    "agg_percentile_disc",
    """SELECT symbol, quantile_disc(revenue, 0.5) AS median_revenue,
              quantile_disc(netincome, 0.5) AS median_netincome,
              quantile_disc(interestexpense, 0.5) AS median_interestexpense,
              quantile_disc(epsdiluted, 0.5) AS median_epsdiluted
       FROM snapshot_new GROUP BY symbol""",
    snapshots=True,
)
def agg_percentile_disc(t):
    wanted = ["revenue", "netincome", "interestexpense", "epsdiluted"]
    return growth.summarise(t["snapshot_new"], ["symbol"], medians=wanted)


@register(
    "agg_percentile_cont",
    """SELECT symbol, period, ROUND(quantile_cont(epsdiluted, 0.5), 6) AS median_epsdiluted
       FROM statement_quarter GROUP BY symbol, period""",
)
def agg_percentile_cont(t):
    return rounded(
        t["income_statement_quarter"]
        .groupBy("symbol", "period")
        .agg(growth.median_cont("epsdiluted").alias("median_epsdiluted"))
    )


@register(
    "agg_distinct_on",
    """SELECT DISTINCT ON (symbol) symbol, date, close, volume FROM price
       ORDER BY symbol, date DESC""",
)
def agg_distinct_on(t):
    quotes = t["price"].select(*KEY, "close", "volume")
    return manifest.first_row_per_key(quotes, ["symbol"], [F.col("date").desc()])


@register(
    "agg_dedup_keep_first",
    """SELECT symbol, date, arg_min(revenue, source) AS revenue FROM (
         SELECT symbol, date, revenue, 0 AS source FROM snapshot_old
         UNION ALL SELECT symbol, date, revenue, 1 FROM snapshot_new) GROUP BY symbol, date""",
    snapshots=True,
)
def agg_dedup_keep_first(t):
    chunks = [t[n].select(*KEY, "revenue") for n in ("snapshot_old", "snapshot_new")]
    return manifest.union_chunks(chunks, KEY)


# --- windows -----------------------------------------------------------------------------

TTM_COLUMNS = [*windows.FLOWS, "totalassets", "totalcurrentliabilities", "weightedaverageshsoutdil"]


@register(
    "win_ttm_sum",
    f"""SELECT symbol, date, {", ".join(c for c in TTM_COLUMNS if c != "epsdiluted")},
               ROUND(epsdiluted, 6) AS epsdiluted
        FROM ({ttm_sql("statement_quarter", "symbol, company_id")})""",
)
def win_ttm_sum(t):
    joined = statements.join_statements(
        t["income_statement_quarter"],
        t["balance_sheet_quarter"],
        t["cash_flow_statement_quarter"],
    )
    return rounded(windows.ttm(joined).select(*KEY, *TTM_COLUMNS))


@register(
    "win_ttm_single",
    """SELECT symbol, date, CAST(SUM(freecashflow) OVER w AS BIGINT) AS freecashflow,
              CAST(SUM(stockbasedcompensation) OVER w AS BIGINT) AS stockbasedcompensation
       FROM cash_flow_statement_quarter
       WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS 3 PRECEDING)""",
)
def win_ttm_single(t):
    flows = ("freecashflow", "stockbasedcompensation")
    cash = t["cash_flow_statement_quarter"].select(*KEY, *flows)
    return windows.ttm(cash, flows=flows, keys=("symbol",))


@register(
    "win_named",
    """SELECT symbol, date, CAST(SUM(freecashflow) OVER w - SUM(stockbasedcompensation) OVER w
                                 AS BIGINT) AS adj_fcf_ttm,
              CAST(COUNT(*) OVER w AS BIGINT) AS quarters
       FROM cash_flow_statement_quarter
       WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS 3 PRECEDING)""",
)
def win_named(t):
    w = windows.ttm_window(["symbol"])
    fcf = F.sum("freecashflow").over(w) - F.sum("stockbasedcompensation").over(w)
    return t["cash_flow_statement_quarter"].select(
        *KEY, fcf.alias("adj_fcf_ttm"), F.count(F.lit(1)).over(w).alias("quarters")
    )


@register(
    "win_row_number_latest",
    """SELECT symbol, date, freecashflow FROM cash_flow_statement_quarter
       QUALIFY ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY date DESC) = 1""",
)
def win_row_number_latest(t):
    w = W.partitionBy("symbol").orderBy(F.desc("date"))
    numbered = t["cash_flow_statement_quarter"].withColumn("rn", F.row_number().over(w))
    return numbered.filter("rn = 1").select(*KEY, "freecashflow")


@register(
    "win_after_join",
    """SELECT s.symbol, s.date, CAST(SUM(s.freecashflow) OVER w AS BIGINT) AS freecashflow, p.close
       FROM cash_flow_statement_quarter s JOIN price p ON p.symbol = s.symbol AND p.date = s.date
       WINDOW w AS (PARTITION BY s.symbol ORDER BY s.date ROWS 3 PRECEDING)""",
)
def win_after_join(t):
    quotes = t["price"].select(*KEY, "close")
    joined = t["cash_flow_statement_quarter"].select(*KEY, "freecashflow").join(quotes, list(KEY))
    return windows.ttm(joined, flows=("freecashflow",), keys=("symbol",))


# --- sorts and limits --------------------------------------------------------------------


@register(
    "sort_desc",
    "SELECT symbol, date, interestexpense FROM snapshot_new ORDER BY interestexpense DESC NULLS FIRST",
    snapshots=True,
)
def sort_desc(t):
    return t["snapshot_new"].select(*KEY, "interestexpense").orderBy(
        F.desc_nulls_first("interestexpense")
    )


@register(
    "sort_multi",
    "SELECT symbol, date, period, revenue FROM statement_quarter ORDER BY symbol, period, date",
)
def sort_multi(t):
    return t["income_statement_quarter"].select(*KEY, "period", "revenue").orderBy(
        "symbol", F.regexp_replace("period", "Q", "").cast("int"), "date"
    )


@register(
    "sort_expr",
    """SELECT symbol, companyname, mktcap FROM company
       ORDER BY mktcap + id - abs(mktcap - id) DESC""",
)
def sort_expr(t):
    score = F.col("mktcap") + F.col("id") - F.abs(F.col("mktcap") - F.col("id"))
    return t["company"].orderBy(score.desc_nulls_first()).select("symbol", "companyname", "mktcap")


@register(
    "topk_latest",
    "SELECT symbol, date, close FROM price ORDER BY date DESC, symbol LIMIT 10",
)
def topk_latest(t):
    return t["price"].select(*KEY, "close").orderBy(F.desc("date"), "symbol").limit(10)


@register(
    "topk_nearest",
    """SELECT symbol, date, CAST(ABS(price_date - date) AS INTEGER) AS gap_days FROM near""",
    ctes=NEAREST,
)
def topk_nearest(t):
    found = asof.nearest_price(t["balance_sheet_quarter"].select(*KEY), t["price"])
    return found.select(*KEY, dates.day_gap("price_date", "date").alias("gap_days"))


@register(
    "sort_inner_redundant",
    """SELECT symbol, companyname, total FROM
       (SELECT symbol, CAST(SUM(revenue) AS BIGINT) AS total FROM statement_fy GROUP BY symbol
        ORDER BY total DESC) JOIN company USING (symbol)""",
)
def sort_inner_redundant(t):
    # The inner order cannot be seen in the result and is left out.
    totals = t["income_statement_fy"].groupBy("symbol").agg(F.sum("revenue").alias("total"))
    return totals.join(t["company"].select("symbol", "companyname"), "symbol")


# --- set operations ----------------------------------------------------------------------


@register(
    "union_all",
    """SELECT symbol, date, revenue FROM snapshot_old
       UNION ALL SELECT symbol, date, revenue FROM snapshot_new""",
    snapshots=True,
)
def union_all(t):
    old, new = (t[n].select(*KEY, "revenue") for n in ("snapshot_old", "snapshot_new"))
    return old.unionByName(new)


@register("dedup", "SELECT DISTINCT symbol, calendaryear FROM statement_quarter")
def dedup(t):
    return t["income_statement_quarter"].select("symbol", "calendaryear").dropDuplicates()
