"""Work lists for ingest: what to load, in which date chunks, and what came back."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens.functions.dates import DateLike, date_lit

# Price history starts here; a price request spans at most this many days.
HISTORY_START = "1900-01-01"
MAX_CHUNK_DAYS = 4900


def default_params(dataset: str, period: str, today: DateLike | None = None) -> dict[str, str]:
    """Request parameters a dataset takes unless the caller gives others."""
    schemas.check_period(period)
    if schemas.DATASETS.get(dataset, ("", False))[1]:
        return {"period": period}
    if dataset == "historical-price-eod/full":
        return {"from": HISTORY_START, "to": str(today or datetime.date.today())}
    return {}


def manifest(
    tickers: DataFrame, period: str | None = None, datasets: Sequence[str] | None = None
) -> DataFrame:
    """One row per ticker, dataset and period.

    ``period`` None means both; profile and price have no period and appear once.
    The dataset list is part of the program, so it is exploded beside each ticker
    row and no join is needed.
    """
    periods = schemas.PERIODS if period is None else (schemas.check_period(period),)
    wanted = list(schemas.DATASETS) if datasets is None else list(datasets)
    entries = []
    for dataset in wanted:
        if schemas.DATASETS[dataset][1]:
            entries += [(dataset, p, schemas.table_for(dataset, p)) for p in periods]
        else:
            entries.append((dataset, None, schemas.table_for(dataset, periods[0])))
    items = F.array(
        *[
            F.struct(
                F.lit(d).alias("dataset"),
                F.lit(p).cast("string").alias("period"),
                F.lit(t).alias("table_name"),
            )
            for d, p, t in entries
        ]
    )
    return tickers.select("symbol", F.inline(items))


def manifest_with_params(work: DataFrame, today: DateLike) -> DataFrame:
    """Add the default request parameters as columns."""
    is_price = F.col("dataset") == "historical-price-eod/full"
    return work.withColumns(
        {
            "param_period": F.col("period"),
            "param_from": F.when(is_price, date_lit(HISTORY_START)),
            "param_to": F.when(is_price, date_lit(today)),
        }
    )


def date_chunks(
    df: DataFrame, start: str = "param_from", end: str = "param_to", max_days: int = MAX_CHUNK_DAYS
) -> DataFrame:
    """Split each row's date range into chunks of ``max_days``.

    A chunk starts the day after the one before ends.  A start on or after the end
    gives no chunk, and neither does a single day left over at the end.
    """
    step = F.make_dt_interval(days=F.lit(max_days + 1))
    starts = F.when(F.col(start) < F.col(end), F.sequence(F.col(start), F.col(end), step))
    return (
        df.select("*", F.posexplode(starts).alias("chunk_no", "chunk_from"))
        .filter(F.col("chunk_from") < F.col(end))
        .withColumn("chunk_to", F.least(F.date_add("chunk_from", max_days), F.col(end)))
    )


def first_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row of each key by ``order``.

    ``row_number() = 1`` is planned with a group limit in front of the shuffle: a map
    task sends one row per key, so a key with very many copies does not meet in one task.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def union_chunks(chunks: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Concatenate chunk results; where keys repeat the earliest chunk's row stays."""
    merged = None
    for number, chunk in enumerate(chunks):
        numbered = chunk.withColumn("_chunk", F.lit(number))
        merged = numbered if merged is None else merged.unionByName(numbered)
    if merged is None:
        raise ValueError("no chunks given")
    rest = [c for c in merged.columns if c not in {*keys, "_chunk"}]
    return first_row_per_key(merged, keys, ["_chunk", *rest]).drop("_chunk")


def uncovered(work: DataFrame, landed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Requested rows for which nothing landed."""
    return work.join(landed.select(*keys), list(keys), "left_anti")
