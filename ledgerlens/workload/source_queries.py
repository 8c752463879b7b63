"""Sources, sinks and normalisation: derived tables are written out and read back."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens.operators import normalize
from ledgerlens.session import work_folder
from ledgerlens.sources import readers, writers
from ledgerlens.sources.store import VersionedStore
from ledgerlens.workload.registry import register

KEY = ("symbol", "date")
INCOME_COLUMNS = (
    *KEY, "calendaryear", "period", "revenue", "interestexpense", "netincome",
    "weightedaverageshsoutdil", "epsdiluted",
)
INCOME_SQL = "SELECT " + ", ".join(INCOME_COLUMNS) + " FROM statement_{}"


def provider_names(df: DataFrame, table: str) -> DataFrame:
    """Stored names back to the provider's spelling, without surrogate columns."""
    names = {f.name.lower(): f.name for f in schemas.provider_schema(table).fields}
    return df.select(*[F.col(c).alias(names[c]) for c in df.columns if c in names])


def write_csv_tree(df: DataFrame, table: str, folder: str) -> str:
    """A tree of headed CSV files, one folder per year."""
    batch = provider_names(df, table)
    dated = batch.withColumn("folder", F.year("date"))
    dated.write.partitionBy("folder").option("header", True).csv(folder)
    return folder


def write_mixed_csv_tree(df: DataFrame, table: str, folder: str) -> str:
    """Files as they come: odd years have their columns turned round behind a quoted note and
    300 further columns, and there is a copy of some rows under another name for the symbol."""
    batch = provider_names(df, table)
    odd = F.year("date") % 2 == 1
    write_csv_tree(df.filter(~odd), table, f"{folder}/plain")
    note = F.concat(F.lit('a "quoted", note on '), "symbol").alias("note")
    more = [F.lit(str(i)).alias(f"extra{i}") for i in range(300)]
    turned = batch.filter(odd).select(note, *more, *reversed(batch.columns))
    for path, part in (("turned", turned), ("refused", batch.withColumnRenamed("symbol", "ticker"))):
        part.write.option("header", True).option("escape", '"').csv(f"{folder}/{path}")
    return folder


@register("src_csv_tree", INCOME_SQL.format("fy"))
def src_csv_tree(t):
    folder = work_folder(t.spark, "csv")
    write_mixed_csv_tree(t["income_statement_fy"], "income_statement_fy", folder)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return readers.read_csv_tree(t.spark, folder, "income_statement_fy").select(*INCOME_COLUMNS)


@register("src_csv_seed_company", "SELECT DISTINCT symbol FROM statement_fy")
def src_csv_seed_company(t):
    folder = work_folder(t.spark, "csv")
    write_csv_tree(t["balance_sheet_fy"], "balance_sheet_fy", folder)
    return readers.seed_companies(readers.read_csv_tree(t.spark, folder))


@register("src_json_records", INCOME_SQL.format("quarter"))
def src_json_records(t):
    # A response is one company's array of records: some hundred quarters at most.
    batch = provider_names(t["income_statement_quarter"], "income_statement_quarter")
    response = F.to_json(F.collect_list(F.struct(*batch.columns)))
    folder = work_folder(t.spark, "json")
    batch.groupBy("symbol").agg(response.alias("value")).select("value").write.text(folder)
    landed = readers.read_json_records(t.spark, folder, "income_statement_quarter", multiline=False)
    return landed.select(*INCOME_COLUMNS)


@register("src_json_tickers", "SELECT symbol FROM company")
def src_json_tickers(t):
    # Documents of up to a thousand entries: an object of objects under running numbers.
    entry = F.struct(
        (F.col("id") % 1000).cast("string").alias("key"),
        F.struct(
            F.col("id").alias("cik_str"),
            F.col("symbol").alias("ticker"),
            F.col("companyname").alias("title"),
        ).alias("value"),
    )
    documents = (
        t["company"]
        .groupBy(F.floor(F.col("id") / 1000).alias("document"))
        .agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))
    )
    folder = work_folder(t.spark, "tickers")
    documents.select("value").write.text(folder)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return readers.read_ticker_json(
            t.spark, f"{folder}-absent", backup=folder, whole_file=False
        )


@register(
    "src_ticker_list",
    "SELECT symbol FROM company UNION ALL SELECT * FROM (VALUES ('MSFT'), ('ADBE'))",
)
def src_ticker_list(t):
    # One ticker a line, untidy, each followed by a blank line.
    untidy = F.concat(F.lit(" "), F.lower("symbol"), F.lit("\t"))
    lines = t["company"].select(F.explode(F.array(untidy, F.lit("  "))).alias("value"))
    folder = work_folder(t.spark, "list")
    lines.write.text(folder)
    return readers.read_ticker_list(t.spark, folder, extra=["msft ", "ADBE"])


def _appended(t) -> str:
    folder = work_folder(t.spark, "append")
    income = t["income_statement_quarter"]
    for wanted in (F.col("calendaryear") <= 1998, F.col("calendaryear") > 1998):
        writers.append_rows(income.filter(wanted), folder, partition_by=("calendaryear",))
    return folder


@register(
    "src_table_scan",
    """SELECT symbol, date, revenue FROM statement_quarter
       WHERE symbol IN (SELECT symbol FROM company WHERE exchangeshortname = 'PNK')""",
)
def src_table_scan(t):
    wanted = t["company"].filter("exchangeshortname = 'PNK'")
    store = VersionedStore(t.spark, work_folder(t.spark, "scan"))
    store.put("income_statement_quarter", t["income_statement_quarter"])
    return store.read_symbols("income_statement_quarter", wanted).select(*KEY, "revenue")


@register("sink_append", INCOME_SQL.format("quarter"))
def sink_append(t):
    return t.spark.read.parquet(_appended(t)).select(*INCOME_COLUMNS)


@register("sink_csv_per_key", "SELECT symbol, date, revenue, epsdiluted FROM statement_fy")
def sink_csv_per_key(t):
    folder = work_folder(t.spark, "per-symbol")
    rows = t["income_statement_fy"].select(*KEY, "revenue", "epsdiluted")
    writers.write_csv_per_symbol(rows, folder)
    return (
        t.spark.read.schema("date date, revenue bigint, epsdiluted double, symbol string")
        .option("header", True)
        .csv(folder)
        .select(*KEY, "revenue", "epsdiluted")
    )


@register(
    "dataset_catalog",
    # Written out, so that the check does not lean on the schemas under test.
    """SELECT 'company' AS table_name, CAST(31 AS INTEGER) AS columns, COUNT(*) AS rows FROM company
       UNION ALL SELECT 'income_statement_fy', 40, COUNT(*) FROM income_statement_fy
       UNION ALL SELECT 'income_statement_quarter', 40, COUNT(*) FROM income_statement_quarter
       UNION ALL SELECT 'balance_sheet_fy', 56, COUNT(*) FROM balance_sheet_fy
       UNION ALL SELECT 'balance_sheet_quarter', 56, COUNT(*) FROM balance_sheet_quarter
       UNION ALL SELECT 'cash_flow_statement_fy', 42, COUNT(*) FROM cash_flow_statement_fy
       UNION ALL SELECT 'cash_flow_statement_quarter', 42, COUNT(*) FROM cash_flow_statement_quarter
       UNION ALL SELECT 'shares_fy', 4, COUNT(*) FROM shares_fy
       UNION ALL SELECT 'price', 9, COUNT(*) FROM price""",
)
def dataset_catalog(t):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        names = schemas.select_tables([*schemas.TABLES, "unknown"])
    empty = schemas.empty_tables(t.spark, names)
    counted = [
        t[n].agg(F.count("*").alias("rows")).select(
            F.lit(n).alias("table_name"), F.lit(len(empty[n].columns)).alias("columns"), "rows"
        )
        for n in names
    ]
    result = counted[0]
    for part in counted[1:]:
        result = result.unionByName(part)
    return result


# --- normalisation -----------------------------------------------------------------------


@register("norm_rename", INCOME_SQL.format("quarter"))
def norm_rename(t):
    batch = provider_names(t["income_statement_quarter"], "income_statement_quarter")
    return normalize.rename_lower(batch).select(*INCOME_COLUMNS)


@register(
    "norm_project",
    """SELECT symbol, date, revenue, CAST(NULL AS BIGINT) AS grossprofit, CAST(NULL AS DOUBLE) AS eps,
              CAST(40 - 2 AS INTEGER) AS columns FROM statement_quarter""",
)
def norm_project(t):
    batch = t["income_statement_quarter"].withColumn("unknown", F.lit("dropped"))
    kept = normalize.project_declared(batch, "income_statement_quarter")
    return kept.select(
        *KEY, "revenue", "grossprofit", "eps", F.lit(len(kept.columns)).alias("columns")
    )


def _text_batch(t) -> DataFrame:
    """Quarterly rows as text; one period carries a bad value in each column."""

    def spoiled(column, period, bad):
        text = F.col(column).cast("string")
        return F.when(F.col("period") == period, bad).otherwise(text).alias(column)

    stamp = F.concat(F.col("date").cast("string"), F.lit(" 03:04:05"))
    return t["income_statement_quarter"].select(
        "symbol",
        "period",
        F.col("date").cast("string").alias("key_date"),
        spoiled("date", "Q1", F.lit("2024-13-01")),
        F.when(F.col("period") == "Q2", "soon").otherwise(stamp).alias("accepteddate"),
        F.when(F.col("period") == "Q3", "n/a")
        .when(F.col("period") == "Q1", F.concat(F.col("calendaryear").cast("string"), F.lit(".0")))
        .otherwise(F.col("calendaryear").cast("string"))
        .alias("calendaryear"),
        # Integers as a tool with gaps in integer columns writes them: 123.0, 1.23E2.
        F.when(F.col("period") == "Q4", F.concat(F.col("revenue").cast("string"), F.lit("x")))
        .when(F.col("period") == "Q1", F.concat(F.col("revenue").cast("string"), F.lit(".0")))
        .when(F.col("period") == "Q2", F.concat(F.col("revenue").cast("string"), F.lit("0E-1")))
        .otherwise(F.col("revenue").cast("string"))
        .alias("revenue"),
        spoiled("epsdiluted", "Q4", F.lit("")),
    )


@register(
    "norm_cast",
    """SELECT symbol, CAST(date AS VARCHAR) AS key_date, CASE WHEN period <> 'Q1' THEN date END AS date,
              CASE WHEN period <> 'Q2' THEN date + INTERVAL '03:04:05' HOUR TO SECOND END AS accepteddate,
              CASE WHEN period <> 'Q3' THEN calendaryear END AS calendaryear,
              CASE WHEN period <> 'Q4' THEN revenue END AS revenue,
              CASE WHEN period <> 'Q4' THEN epsdiluted END AS epsdiluted
       FROM statement_quarter""".replace("INTERVAL '03:04:05' HOUR TO SECOND", "TIME '03:04:05'"),
)
def norm_cast(t):
    return normalize.cast_declared(_text_batch(t), "income_statement_quarter").drop("period")


@register(
    "norm_calendaryear",
    """SELECT symbol, CAST(date AS VARCHAR) AS key_date,
              CASE WHEN period <> 'Q3' THEN calendaryear END AS calendaryear FROM statement_quarter""",
)
def norm_calendaryear(t):
    batch = _text_batch(t).select("symbol", "key_date", "calendaryear")
    return normalize.cast_declared(batch, "income_statement_quarter")


@register("norm_date_key", "SELECT symbol, date, revenue FROM statement_quarter")
def norm_date_key(t):
    # Half of the dates arrive with a time of day.
    text = F.col("date").cast("string")
    mixed = F.when(F.quarter("date") > 2, F.concat(text, F.lit(" 16:00:00"))).otherwise(text)
    batch = t["income_statement_quarter"].select("symbol", mixed.alias("date"), "revenue")
    return normalize.cast_declared(batch, "income_statement_quarter")


@register(
    "norm_nan_null",
    """SELECT symbol, date, CASE WHEN period <> 'Q2' THEN epsdiluted END AS epsdiluted
       FROM statement_quarter""",
)
def norm_nan_null(t):
    nan = F.lit(float("nan"))
    holed = F.when(F.col("period") == "Q2", nan).otherwise(F.col("epsdiluted"))
    return normalize.nan_to_null(
        t["income_statement_quarter"].select(*KEY, holed.alias("epsdiluted"))
    )


@register(
    "schema_add_columns",
    "SELECT symbol, id, ceo, CAST(NULL AS VARCHAR) AS isin, CAST(NULL AS DOUBLE) AS beta FROM company",
)
def schema_add_columns(t):
    company = t["company"].select("symbol", "id", "ceo")
    return normalize.add_columns(company, {"ceo": "string", "isin": "string", "beta": "double"})
