"""Financial tables derived from the star-schema test data.

``lineitem`` is read as the sales of a company (supplier).  All amounts are integers
per row before they are summed, so sums are exact.  ``SQL_PREFIX`` states the same
derivation for the SQL check.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.statements import HEADER, shares_from_income
from ledgerlens.session import configure, shared_root, work_folder
from ledgerlens.sources.writers import bucket_count, write_bucketed

INCOME = (
    "revenue",
    "costofrevenue",
    "ebitda",
    "depreciationandamortization",
    "operatingincome",
    "interestexpense",
    "netincome",
    "weightedaverageshsoutdil",
    "epsdiluted",
)
BALANCE = ("totalassets", "totalcurrentliabilities", "cashandcashequivalents", "longtermdebt")
CASH_FLOW = ("netincome", "operatingcashflow", "freecashflow", "stockbasedcompensation")
SUMS = tuple(dict.fromkeys(c for c in (*INCOME, *BALANCE, *CASH_FLOW) if c != "epsdiluted"))


def _cents(column: str):
    return F.round(F.col(column) * 100).cast("bigint")


def symbol_of(key: str):
    return F.concat(F.lit("T"), F.lpad(F.col(key).cast("string"), 10, "0"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines with integer amounts."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_suppkey",
        F.col("l_shipdate").cast("date").alias("d"),
        _cents("l_extendedprice").alias("c"),
        _cents("l_discount").alias("disc"),
        _cents("l_tax").alias("tax"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        "l_returnflag",
        "l_linestatus",
        "l_linenumber",
    )


def _known():
    """Whether the stored snapshot has a sale."""
    day = F.col("d")
    return (day < F.lit("1999-01-01").cast("date")) | (
        (F.col("l_linestatus") == "F") & (day < F.lit("2001-01-01").cast("date"))
    )


def quarter_parts(lines: DataFrame) -> DataFrame:
    """Sums per company, quarter and whether the stored snapshot has the sale: what both states
    of the quarters are put together from.

    The sums combine on the map side, so a company with very many sales sends a few rows
    per quarter and task, not its sales.  Each is a sum that several columns share, over the rows
    where what it multiplies is there: NULL amounts drop out of the columns they belong to only.
    """
    c, disc, tax = F.col("c"), F.col("disc"), F.col("tax")
    no = F.lit(0).cast("bigint")
    both = disc.isNotNull() & tax.isNotNull()
    sums = {
        "c": c,
        "c_disc": F.when(disc.isNotNull(), c),
        "c_tax": F.when(tax.isNotNull(), c),
        "c_both": F.when(both, c),
        "disc": c * disc,
        "tax": c * tax,
        "disc_tax": c * (disc + tax),
        "returned": F.when(F.col("l_returnflag") == "R", c).otherwise(no),
        "qty": F.col("qty"),
        "open": F.when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 7), c).otherwise(no),
        "stock": c * F.when(F.col("l_linenumber") == 1, 12).otherwise(2),
    }
    quarter_end = F.last_day(F.add_months(F.trunc("d", "quarter"), 2))
    known = F.coalesce(_known(), F.lit(False))
    summed = (
        lines.select("l_suppkey", quarter_end.alias("date"), known.alias("known"), *[e.alias(n) for n, e in sums.items()])
        .groupBy("l_suppkey", "date", "known")
        .agg(*[F.sum(n).alias(n) for n in sums])
    )
    return summed.select(symbol_of("l_suppkey").alias("symbol"), (F.col("l_suppkey") + 1).alias("company_id"), "date", "known", *sums)


def quarter_statements(parts: DataFrame) -> DataFrame:
    """One wide quarterly row per company, from the sums of ``quarter_parts``."""
    by = ["symbol", "company_id", "date"]
    sums = parts.groupBy(*by).agg(*[F.sum(n).alias(n) for n in parts.columns if n not in {*by, "known"}])
    c, c_disc, c_tax, c_both = F.col("c"), F.col("c_disc"), F.col("c_tax"), F.col("c_both")
    wide = {
        "revenue": c * 100,
        "costofrevenue": F.col("disc") + c_disc * 50,
        "ebitda": c_disc * 50 - F.col("disc"),
        "depreciationandamortization": F.col("tax"),
        "operatingincome": c_both * 50 - F.col("disc_tax"),
        "interestexpense": F.col("returned") * 9,
        "netincome": c_both * 40 - F.col("disc_tax"),
        "weightedaverageshsoutdil": F.col("qty") * 1000,
        "totalassets": c * 300,
        "totalcurrentliabilities": F.col("tax") + c_tax * 60,
        "cashandcashequivalents": c * 20,
        "longtermdebt": F.col("open"),
        "operatingcashflow": c_disc * 45 - F.col("disc"),
        "freecashflow": c_disc * 16 - F.col("disc") * 2,
        "stockbasedcompensation": F.col("stock"),
    }
    return sums.select(*by, *[e.alias(n) for n, e in wide.items()]).select(
        *by,
        F.year("date").alias("calendaryear"),
        F.concat(F.lit("Q"), F.quarter("date").cast("string")).alias("period"),
        *SUMS,
        _eps().alias("epsdiluted"),
    )


def _eps():
    return F.col("netincome").cast("double") / F.col("weightedaverageshsoutdil")


def year_statements(quarters: DataFrame) -> DataFrame:
    """Fiscal years rolled up from the quarters; no second pass over the sales."""
    return (
        quarters.groupBy("symbol", "company_id", "calendaryear")
        .agg(*[F.sum(c).alias(c) for c in SUMS])
        .select(
            "symbol",
            "company_id",
            F.make_date("calendaryear", F.lit(12), F.lit(31)).alias("date"),
            "calendaryear",
            F.lit("FY").alias("period"),
            *SUMS,
            _eps().alias("epsdiluted"),
        )
    )


def prices(lines: DataFrame) -> DataFrame:
    """Daily price per company: amount over quantity.

    A company sells little more than once a day, so sums that combine before an exchange would save
    hardly a row and hold as many groups as the task has lines.  ``lines`` that are already parted
    by symbol are summed where they are; a company with very many sales streams them into
    one group a day.
    """
    unit = F.col("c").cast("double") / F.col("qty") / 100
    return (
        lines.groupBy("symbol", "l_suppkey", "d")
        .agg(
            F.sum("c").alias("amount"),
            F.sum("qty").alias("units"),
            F.max(unit).alias("high"),
            F.min(unit).alias("low"),
            F.count("*").alias("volume"),
        )
        .select(
            "symbol",
            (F.col("l_suppkey") + 1).alias("company_id"),
            F.col("d").alias("date"),
            "high",
            "low",
            (F.col("amount").cast("double") / F.col("units") / 100).alias("close"),
            "volume",
        )
    )


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    balance = F.col("s_acctbal")
    nation = F.col("s_nationkey")
    return (
        read("supplier")
        .join(read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            (F.col("s_suppkey") + 1).alias("id"),
            symbol_of("s_suppkey").alias("symbol"),
            F.col("s_name").alias("companyname"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("sector"),
            F.when(balance < 500, "PNK").otherwise("NYSE").alias("exchangeshortname"),
            F.concat(F.lit("CEO "), "s_name").alias("ceo"),
            F.concat(F.lit("about "), "s_name").alias("description"),
            F.col("n_name").alias("industry"),
            F.make_date(F.lit(2005) + F.floor(nation / 2).cast("int"), F.lit(1), F.lit(15)).alias(
                "ipodate"
            ),
            F.when((balance >= 700) & (balance < 900), F.lit(None))
            .otherwise(balance >= 9500)
            .alias("isetf"),
            ((balance >= 9000) & (balance < 9500)).alias("isfund"),
            (balance >= 0).alias("isactivelytrading"),
            (_cents("s_acctbal") * 400).alias("mktcap"),
        )
    )


def stored_snapshot(parts: DataFrame, company: DataFrame) -> DataFrame:
    """An earlier state of the quarters, as an upsert finds it.

    Later sales are partly missing, the last year wholly, and so are companies listed
    after 2015.
    """
    listed = company.filter(F.year("ipodate") <= 2015)
    return quarter_statements(parts.filter("known")).join(listed.select("symbol"), "symbol", "left_semi")


class Warehouse(dict):
    """Derived tables by name, each written once per application, bucketed by symbol."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir
        self._tag = uuid.uuid4().hex[:8]
        self._folder = work_folder(spark, "tables") if shared_root(spark) else None
        self._buckets = None

    def __missing__(self, name: str) -> DataFrame:
        df = self[name] = self._make(name)
        return df

    def _stored(self, name: str, df: DataFrame, sort: Sequence[str] = ()) -> DataFrame:
        """Written and bucketed where a shared folder exists, else the plan itself."""
        if self._folder is None:
            return df
        table = f"ledgerlens_{self._tag}_{name}"
        return write_bucketed(df, table, f"{self._folder}/{name}", self._bucket_count(), sort=sort)

    def _bucket_count(self) -> int:
        if self._buckets is None:
            # No derived table has more rows than there are sales; both counts come from file footers.
            suppliers, lines = (self.spark.read.parquet(f"{self.sf_dir}/{n}.parquet").count() for n in ("supplier", "lineitem"))
            self._buckets = bucket_count(suppliers, lines)
        return self._buckets

    def _lines_by_symbol(self) -> DataFrame:
        """The sales a price needs, exchanged as the buckets are, so that the sums and the write of
        the table need no further exchange."""
        lines = sales(self.spark, self.sf_dir).select(symbol_of("l_suppkey").alias("symbol"), "l_suppkey", "d", "c", "qty")
        return lines if self._folder is None else lines.repartition(self._bucket_count(), "symbol")

    def _make(self, name: str) -> DataFrame:
        spark, sf_dir = self.spark, self.sf_dir
        by_date = ["company_id", "date"]
        if name == "company":
            return self._stored(name, companies(spark, sf_dir))
        if name == "price":
            return self._stored(name, prices(self._lines_by_symbol()), ["date"])
        if name == "quarter_part":
            return self._stored(name, quarter_parts(sales(spark, sf_dir)), by_date)
        if name == "statement_quarter":
            return self._stored(name, quarter_statements(self["quarter_part"]), by_date)
        if name == "statement_fy":
            return self._stored(name, year_statements(self["statement_quarter"]), by_date)
        if name == "snapshot_old":
            df = stored_snapshot(self["quarter_part"], self["company"])
            return self._stored(name, df, by_date)
        if name == "snapshot_new":
            blank = F.when(F.col("period") != "Q4", F.col("interestexpense"))
            return self["statement_quarter"].withColumn("interestexpense", blank)
        if name == "shares_fy":
            return shares_from_income(self["statement_fy"])
        stem, _, period = name.rpartition("_")
        columns = {
            "income_statement": INCOME,
            "balance_sheet": BALANCE,
            "cash_flow_statement": CASH_FLOW,
        }[stem]
        return self[f"statement_{period}"].select(*HEADER, *columns)


_WAREHOUSES: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The application's derived tables of a data folder."""
    key = (spark.conf.get("spark.app.id", ""), sf_dir)
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = Warehouse(spark, sf_dir)
    configure(spark)
    return _WAREHOUSES[key]


def _statement_select(end: str, period: str, source: str = "li", where: str = "") -> str:
    return f"""
  SELECT concat('T', lpad(CAST(l_suppkey AS VARCHAR), 10, '0')) AS symbol,
         l_suppkey + 1 AS company_id, {end} AS date,
         CAST(year({end}) AS INTEGER) AS calendaryear, {period} AS period,
         CAST(SUM(c * 100) AS BIGINT) AS revenue,
         CAST(SUM(c * (50 + disc)) AS BIGINT) AS costofrevenue,
         CAST(SUM(c * (50 - disc)) AS BIGINT) AS ebitda,
         CAST(SUM(c * tax) AS BIGINT) AS depreciationandamortization,
         CAST(SUM(c * (50 - disc - tax)) AS BIGINT) AS operatingincome,
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN c * 9 ELSE 0 END) AS BIGINT) AS interestexpense,
         CAST(SUM(c * (40 - disc - tax)) AS BIGINT) AS netincome,
         CAST(SUM(qty) * 1000 AS BIGINT) AS weightedaverageshsoutdil,
         CAST(SUM(c * (40 - disc - tax)) AS DOUBLE) / CAST(SUM(qty) * 1000 AS DOUBLE) AS epsdiluted,
         CAST(SUM(c * 300) AS BIGINT) AS totalassets,
         CAST(SUM(c * (60 + tax)) AS BIGINT) AS totalcurrentliabilities,
         CAST(SUM(c * 20) AS BIGINT) AS cashandcashequivalents,
         CAST(SUM(CASE WHEN l_linestatus = 'O' AND l_linenumber = 7 THEN c ELSE 0 END) AS BIGINT)
           AS longtermdebt,
         CAST(SUM(c * (45 - disc)) AS BIGINT) AS operatingcashflow,
         CAST(SUM(c * (16 - 2 * disc)) AS BIGINT) AS freecashflow,
         CAST(SUM(c * CASE WHEN l_linenumber = 1 THEN 12 ELSE 2 END) AS BIGINT)
           AS stockbasedcompensation
  FROM {source} {where} GROUP BY l_suppkey, {end}"""


def _subset(columns, period: str) -> str:
    return f"SELECT {', '.join((*HEADER, *columns))} FROM statement_{period}"


SQL_PREFIX = f"""WITH li AS (
  SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d,
         CAST(date_trunc('quarter', l_shipdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS qend,
         CAST(date_trunc('year', l_shipdate) + INTERVAL 12 MONTH - INTERVAL 1 DAY AS DATE) AS yend,
         CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS c,
         CAST(ROUND(l_discount * 100) AS BIGINT) AS disc,
         CAST(ROUND(l_tax * 100) AS BIGINT) AS tax, CAST(l_quantity AS BIGINT) AS qty,
         l_returnflag, l_linestatus, l_linenumber
  FROM lineitem),
company AS (
  SELECT s_suppkey + 1 AS id, concat('T', lpad(CAST(s_suppkey AS VARCHAR), 10, '0')) AS symbol,
         s_name AS companyname, n_name AS country, r_name AS sector,
         CASE WHEN s_acctbal < 500 THEN 'PNK' ELSE 'NYSE' END AS exchangeshortname,
         concat('CEO ', s_name) AS ceo, concat('about ', s_name) AS description,
         n_name AS industry, make_date(2005 + s_nationkey // 2, 1, 15) AS ipodate,
         CASE WHEN s_acctbal >= 700 AND s_acctbal < 900 THEN NULL ELSE s_acctbal >= 9500 END AS isetf,
         s_acctbal >= 9000 AND s_acctbal < 9500 AS isfund, s_acctbal >= 0 AS isactivelytrading,
         CAST(ROUND(s_acctbal * 100) AS BIGINT) * 400 AS mktcap
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
statement_quarter AS ({_statement_select("qend", "concat('Q', CAST(quarter(qend) AS VARCHAR))")}),
statement_fy AS ({_statement_select("yend", "'FY'")}),
price AS (
  SELECT concat('T', lpad(CAST(l_suppkey AS VARCHAR), 10, '0')) AS symbol,
         l_suppkey + 1 AS company_id, d AS date,
         MAX(CAST(c AS DOUBLE) / qty / 100) AS high, MIN(CAST(c AS DOUBLE) / qty / 100) AS low,
         CAST(SUM(c) AS DOUBLE) / CAST(SUM(qty) AS DOUBLE) / 100 AS close, COUNT(*) AS volume
  FROM li GROUP BY l_suppkey, d),
income_statement_quarter AS ({_subset(INCOME, "quarter")}),
balance_sheet_quarter AS ({_subset(BALANCE, "quarter")}),
cash_flow_statement_quarter AS ({_subset(CASH_FLOW, "quarter")}),
income_statement_fy AS ({_subset(INCOME, "fy")}),
balance_sheet_fy AS ({_subset(BALANCE, "fy")}),
cash_flow_statement_fy AS ({_subset(CASH_FLOW, "fy")}),
shares_fy AS (
  SELECT symbol, company_id, date, weightedaverageshsoutdil AS numberofshares FROM statement_fy)"""

SQL_SNAPSHOTS = f"""
snapshot_all AS ({_statement_select(
    "qend", "concat('Q', CAST(quarter(qend) AS VARCHAR))",
    where="WHERE d < DATE '1999-01-01' OR (l_linestatus = 'F' AND d < DATE '2001-01-01')")}),
snapshot_old AS (
  SELECT * FROM snapshot_all WHERE symbol IN (SELECT symbol FROM company WHERE year(ipodate) <= 2015)),
snapshot_new AS (
  SELECT * REPLACE (CASE WHEN period <> 'Q4' THEN interestexpense END AS interestexpense)
  FROM statement_quarter)"""
