"""Dataset catalog: fixed table schemas, dataset-to-table mapping and merge keys.

Columns carry the provider's camelCase spelling; the stored (physical) name is the
lower-cased one.  Money and share counts are 64-bit integers, ratios and prices are
doubles.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Column names and types of each table, in table order.
COMPANY = """
id bigint, symbol string, companyName string, currency string, cik bigint, isin string,
cusip string, exchange string, exchangeShortName string, industry string, website string,
description string, ceo string, sector string, country string, fullTimeEmployees bigint,
phone string, address string, city string, state string, zip string, image string,
ipoDate date, isEtf boolean, isActivelyTrading boolean, isAdr boolean, isFund boolean,
price double, mktCap bigint, beta double, lastDiv double
"""

INCOME_STATEMENT = """
id bigint, company_id bigint, date date, symbol string, reportedCurrency string, cik bigint,
fillingDate date, acceptedDate timestamp_ntz, calendarYear int, period string,
revenue bigint, costOfRevenue bigint, grossProfit bigint, grossProfitRatio double,
researchAndDevelopmentExpenses bigint, generalAndAdministrativeExpenses bigint,
sellingAndMarketingExpenses bigint, sellingGeneralAndAdministrativeExpenses bigint,
otherExpenses bigint, operatingExpenses bigint, costAndExpenses bigint,
interestIncome bigint, interestExpense bigint, depreciationAndAmortization bigint,
ebitda bigint, ebitdaratio double, operatingIncome bigint, operatingIncomeRatio double,
totalOtherIncomeExpensesNet bigint, incomeBeforeTax bigint, incomeBeforeTaxRatio double,
incomeTaxExpense bigint, netIncome bigint, netIncomeRatio double, eps double,
epsdiluted double, weightedAverageShsOut bigint, weightedAverageShsOutDil bigint,
link string, finalLink string
"""

BALANCE_SHEET = """
id bigint, company_id bigint, date date, symbol string, reportedCurrency string, cik bigint,
fillingDate date, acceptedDate timestamp_ntz, calendarYear int, period string,
cashAndCashEquivalents bigint, shortTermInvestments bigint, cashAndShortTermInvestments bigint,
netReceivables bigint, inventory bigint, otherCurrentAssets bigint, totalCurrentAssets bigint,
propertyPlantEquipmentNet bigint, goodwill bigint, intangibleAssets bigint,
goodwillAndIntangibleAssets bigint, longTermInvestments bigint, taxAssets bigint,
otherNonCurrentAssets bigint, totalNonCurrentAssets bigint, otherAssets bigint,
totalAssets bigint, accountPayables bigint, shortTermDebt bigint, taxPayables bigint,
deferredRevenue bigint, otherCurrentLiabilities bigint, totalCurrentLiabilities bigint,
longTermDebt bigint, deferredRevenueNonCurrent bigint, deferredTaxLiabilitiesNonCurrent bigint,
otherNonCurrentLiabilities bigint, totalNonCurrentLiabilities bigint, otherLiabilities bigint,
capitalLeaseObligations bigint, totalLiabilities bigint, preferredStock bigint,
commonStock bigint, retainedEarnings bigint, accumulatedOtherComprehensiveIncomeLoss bigint,
othertotalStockholdersEquity bigint, totalStockholdersEquity bigint, totalEquity bigint,
totalLiabilitiesAndStockholdersEquity bigint, minorityInterest bigint,
totalLiabilitiesAndTotalEquity bigint, totalInvestments bigint, totalDebt bigint,
netDebt bigint, link string, finalLink string
"""

CASH_FLOW_STATEMENT = """
id bigint, company_id bigint, date date, symbol string, reportedCurrency string, cik bigint,
fillingDate date, acceptedDate timestamp_ntz, calendarYear int, period string,
netIncome bigint, depreciationAndAmortization bigint, deferredIncomeTax bigint,
stockBasedCompensation bigint, changeInWorkingCapital bigint, accountsReceivables bigint,
inventory bigint, accountsPayables bigint, otherWorkingCapital bigint,
otherNonCashItems bigint, netCashProvidedByOperatingActivities bigint,
investmentsInPropertyPlantAndEquipment bigint, acquisitionsNet bigint,
purchasesOfInvestments bigint, salesMaturitiesOfInvestments bigint,
otherInvestingActivites bigint, netCashUsedForInvestingActivites bigint,
debtRepayment bigint, commonStockIssued bigint, commonStockRepurchased bigint,
dividendsPaid bigint, otherFinancingActivites bigint,
netCashUsedProvidedByFinancingActivities bigint, effectOfForexChangesOnCash bigint,
netChangeInCash bigint, cashAtEndOfPeriod bigint, cashAtBeginningOfPeriod bigint,
operatingCashFlow bigint, capitalExpenditure bigint, freeCashFlow bigint,
link string, finalLink string
"""

SHARES = "company_id bigint, symbol string, date date, numberofshares bigint"

PRICE = """
id bigint, company_id bigint, symbol string, date date, open double, high double,
low double, close double, volume bigint
"""

# Stored tables.
TABLES = {
    "company": COMPANY,
    "income_statement_fy": INCOME_STATEMENT,
    "income_statement_quarter": INCOME_STATEMENT,
    "balance_sheet_fy": BALANCE_SHEET,
    "balance_sheet_quarter": BALANCE_SHEET,
    "cash_flow_statement_fy": CASH_FLOW_STATEMENT,
    "cash_flow_statement_quarter": CASH_FLOW_STATEMENT,
    "shares_fy": SHARES,
    "price": PRICE,
}

# Provider dataset names, the table stem they load, and whether they have a period.
DATASETS = {
    "profile": ("company", False),
    "income-statement": ("income_statement", True),
    "balance-sheet-statement": ("balance_sheet", True),
    "cash-flow-statement": ("cash_flow_statement", True),
    "historical-price-eod/full": ("price", False),
}

# Columns that identify a row of a dataset; ``period`` counts where a batch has it.
MERGE_KEYS = {
    "profile": ("symbol",),
    "income-statement": ("symbol", "calendaryear", "period"),
    "balance-sheet-statement": ("symbol", "calendaryear", "period"),
    "cash-flow-statement": ("symbol", "calendaryear", "period"),
    "historical-price-eod/full": ("symbol", "date"),
}

#: when and from which file a row landed; orders rows of one key, never stored
LANDING = ("_landed_at", "_landed_file")

PERIODS = ("quarter", "fy")

#: columns the engine assigns itself; never part of a provider batch
SURROGATES = ("id", "company_id")


TYPES = {
    "bigint": LongType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "double": DoubleType(),
    "int": IntegerType(),
    "string": StringType(),
    "timestamp_ntz": TimestampNTZType(),
}


def _fields(table: str) -> list[StructField]:
    """Declared columns with the provider's names; needs no session."""
    pairs = [column.split() for column in TABLES[table].split(",")]
    return [StructField(name, TYPES[kind]) for name, kind in pairs]


def check_period(period: str) -> str:
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}, got {period!r}")
    return period


def provider_schema(table: str) -> StructType:
    """Schema of a provider batch: camelCase names, without surrogate columns."""
    return StructType([f for f in _fields(table) if f.name not in SURROGATES])


def table_schema(table: str) -> StructType:
    """Schema of the stored table: lower-case names."""
    return StructType([StructField(f.name.lower(), f.dataType) for f in _fields(table)])


def compared_columns(table: str) -> list[str]:
    """Declared columns that an upsert compares, each once, in table order."""
    names = [f.name for f in table_schema(table).fields if f.name not in SURROGATES]
    return list(dict.fromkeys(names))


def column_type(table: str, column: str):
    """Spark type of a stored column."""
    return table_schema(table)[column.lower()].dataType


def table_for(dataset: str, period: str) -> str:
    """Table loaded by a dataset for a period."""
    check_period(period)
    stem, periodic = DATASETS[dataset]
    return f"{stem}_{period}" if periodic else stem


def merge_keys(dataset: str, columns: Iterable[str]) -> list[str]:
    """Columns that identify a row of the dataset."""
    optional = {"period"} - set(columns)
    return [key for key in MERGE_KEYS[dataset] if key not in optional]


def select_tables(names: Sequence[str] | None = None) -> list[str]:
    """Known tables among ``names``; all of them when ``names`` is empty or None."""
    if not names:
        return list(TABLES)
    unknown = [n for n in names if n not in TABLES]
    for name in unknown:
        warnings.warn(f"table {name!r} is not known and is skipped", stacklevel=2)
    return [n for n in names if n in TABLES]


def empty_tables(spark: SparkSession, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Empty DataFrames with the stored schema of each selected table."""
    return {n: spark.createDataFrame([], table_schema(n)) for n in select_tables(names)}
