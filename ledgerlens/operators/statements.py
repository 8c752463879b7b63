"""Joins of statement tables with each other and with the company dimension.

Statement rows are unique on (symbol, date), so a join never fans out and a symbol
holds at most one row per reporting date.  The symbol is part of every join key:
it is fixed by ``company_id``, and tables bucketed by symbol then join, window and
aggregate without a shuffle.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

STATEMENT_KEYS = ("symbol", "company_id", "date")
HEADER = ("symbol", "company_id", "date", "calendaryear", "period")


def join_statements(
    income: DataFrame,
    balance: DataFrame,
    cash_flow: DataFrame,
    keys: Sequence[str] = STATEMENT_KEYS,
) -> DataFrame:
    """Income, balance-sheet and cash-flow rows of the same company and date.

    Where a column occurs in more than one statement the income statement's stays.
    """
    taken = set(income.columns)
    balance = balance.select(*keys, *[c for c in balance.columns if c not in taken])
    taken |= set(balance.columns)
    cash_flow = cash_flow.select(*keys, *[c for c in cash_flow.columns if c not in taken])
    return income.join(balance, list(keys)).join(cash_flow, list(keys))


def join_shares(facts: DataFrame, shares: DataFrame) -> DataFrame:
    """Add the reported number of shares of the same company and date."""
    keys = [k for k in STATEMENT_KEYS if k in shares.columns]
    return facts.join(shares.select(*keys, "numberofshares"), keys)


def shares_from_income(income: DataFrame) -> DataFrame:
    """Share counts derived from the diluted weighted average."""
    return income.select(
        *[c for c in STATEMENT_KEYS if c in income.columns],
        F.col("weightedaverageshsoutdil").alias("numberofshares"),
    )


def join_company(facts: DataFrame, company: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add company columns by id; no broadcast is forced, the table may be large."""
    wanted = [c for c in columns if c not in facts.columns]
    ids = company.select("symbol", F.col("id").alias("company_id"), *wanted)
    return facts.join(ids, ["symbol", "company_id"])


def has_capital() -> Column:
    return F.col("totalassets") - F.col("totalcurrentliabilities") != 0


def keep_symbols(df: DataFrame, symbols: Collection[str] | DataFrame | None) -> DataFrame:
    """Rows of the listed symbols; all rows for None.

    A list becomes an IN filter that reaches the scan, whatever its length; a DataFrame, for
    lists that are data themselves, a semi join, which does not repeat rows when it has repeats.
    """
    if symbols is None:
        return df
    if isinstance(symbols, DataFrame):
        return df.join(symbols.select("symbol"), "symbol", "left_semi")
    return df.filter(F.col("symbol").isin(sorted(set(symbols))))


def latest_rows(df: DataFrame, key: str = "symbol", order: str = "date") -> DataFrame:
    """Rows at each key's latest date; ties stay, as in a join with the maximum.

    ``rank() = 1`` is group-limited before any shuffle.
    """
    w = W.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("_rank", F.rank().over(w)).filter("_rank = 1").drop("_rank")


def latest_values(
    df: DataFrame, columns: Sequence[str], key: str = "symbol", order: str = "date"
) -> DataFrame:
    """Latest value of a few numeric columns per key.

    A hash aggregate with map-side combine: rows are neither sorted nor shuffled raw.
    Needs unique (key, order).
    """
    return df.groupBy(key).agg(*[F.max_by(c, order).alias(c) for c in columns])
