"""Surrogate ids and foreign-key resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: leading hex digits of the key's hash that form an id group: 16**3 groups
GROUP_DIGITS = 3


def _id_group(key: str) -> Column:
    return F.substring(F.md5(F.col(key)), 1, GROUP_DIGITS)


def surrogate_ids(
    df: DataFrame, key: str, start: DataFrame | None = None, name: str = "id"
) -> DataFrame:
    """Add gap-free ids 1..n to rows with a unique text ``key``, above ``start``'s value.

    The order is (hash group, key).  Rows are numbered inside their hash group and a
    group's offset is the running count of the groups before it.  Only the at most
    4096 group counts meet in one task; rows are spread evenly by the hash, and the
    outcome does not depend on the number of partitions.  ``start`` is a one-row
    DataFrame with column ``max_id``.
    """
    grouped = df.withColumn("_group", _id_group(key))
    counts = grouped.groupBy("_group").agg(F.count("*").alias("_n"))
    if start is not None:
        # An empty group name sorts first: ids in use count as rows before all others.
        used = start.select(F.lit("").alias("_group"), F.coalesce("max_id", F.lit(0)).alias("_n"))
        counts = counts.unionByName(used)
    before = W.orderBy("_group").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    inside = F.row_number().over(W.partitionBy("_group").orderBy(key))
    return (
        grouped.withColumn("_inside", inside)
        .join(F.broadcast(offsets), "_group")
        .withColumn(name, (F.col("_offset") + F.col("_inside")).cast("bigint"))
        .drop("_group", "_offset", "_inside")
    )


def stub_companies(facts: DataFrame, company: DataFrame) -> DataFrame:
    """New companies, symbol and id only, for symbols the company table lacks."""
    missing = (
        facts.select("symbol")
        .filter(F.col("symbol").isNotNull())
        .distinct()
        .join(company.select("symbol"), "symbol", "left_anti")
    )
    top = company.agg(F.max("id").alias("max_id"))
    return surrogate_ids(missing, "symbol", start=top).select("id", "symbol")


def with_stubs(facts: DataFrame, company: DataFrame) -> DataFrame:
    """Company table extended by a stub for each unknown symbol of ``facts``."""
    return company.unionByName(stub_companies(facts, company), allowMissingColumns=True)


def fk_resolve(facts: DataFrame, company: DataFrame) -> DataFrame:
    """Fill ``company_id`` from the company with the same symbol, NULL if unknown.

    ``company`` should already hold the stubs (``with_stubs``).
    """
    if "company_id" in facts.columns:
        raise ValueError("company_id is assigned here and must not be in the input")
    if "symbol" not in facts.columns:
        raise ValueError("input has no symbol column")
    ids = company.select("symbol", F.col("id").alias("company_id"))
    return facts.join(ids, "symbol", "left").select("company_id", *facts.columns)
