"""Price lookups: nearest in time, or on the exact weekend-adjusted date."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlens.functions.dates import day_gap, weekend_roll


def slice_edges(quoted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What lies beyond the slices of a key, from its prices (_key, _slice, _at, _here).

    First (_key, _slice, _before, _after): for each slice from a key's first price to its last, also
    those without one, the last price before it and the first one after.  Second (_key, _ends):
    first and last slice of a key with their outer prices.  Both are small tables, with rows for
    keys and slices; edges are aggregated on the map side, and only they are put in order by key.
    """
    here = F.struct("_at", "_here")
    edges = quoted.groupBy("_key", "_slice").agg(F.min(here).alias("_first"), F.max(here).alias("_last"))
    order = W.partitionBy("_key").orderBy("_slice")
    edges = edges.select(
        "_key",
        "_slice",
        F.col("_first._here").alias("_first"),
        F.col("_last._here").alias("_last"),
        F.lag("_last._here").over(order).alias("_past"),
        F.lead("_first._here").over(order).alias("_coming"),
        F.lead("_slice").over(order).alias("_next"),
    )
    slices = F.sequence("_slice", F.coalesce(F.col("_next") - 1, F.col("_slice")))
    filled = edges.withColumn("_in", F.explode(slices))
    before = F.when(F.col("_in") == F.col("_slice"), F.col("_past")).otherwise(F.col("_last"))
    filled = filled.select("_key", F.col("_in").alias("_slice"), before.alias("_before"), F.col("_coming").alias("_after"))
    place = F.col("_slice")
    ends = edges.groupBy("_key").agg(
        F.struct(
            F.min(place).alias("from"), F.max(place).alias("to"), F.min_by("_first", place).alias("first"), F.max_by("_last", place).alias("last")
        ).alias("_ends")
    )
    return filled, ends


def nearest_price(
    df: DataFrame,
    price: DataFrame,
    key: str = "symbol",
    order: str = "date",
    columns: Sequence[str] = ("close",),
    repeated_dates: bool = False,
    slice_of: Callable[[Column], Column] = F.year,
) -> DataFrame:
    """Each row with the price closest in time, before or after; earlier on a tie.

    Rows of a key without a price stay, with NULL.  Adds ``price_date`` and the price
    ``columns``.  The unit of work is a slice of a key, its rows of one year: inside it each price
    knows the next one, both sides are laid in one stream ordered by date and the last price seen
    is carried along, in one ordered pass and without pairs of rows.  What lies before and after a
    slice comes from a small table of the first and last price of each.  So a task is bounded by
    the rows of a slice and not by those of a key; ``slice_of`` makes other slices of ``order``,
    whole numbers that grow with it.  Left columns travel as one struct, so price rows stay narrow.  If
    both sides are bucketed by the key the union keeps the partitioning and nothing is shuffled.

    Rows without a date find no price.  ``df`` may hold a key and
    date many times only with ``repeated_dates``: the lookup is then made once per distinct key and
    date and joined back.
    """
    if repeated_dates:
        dates = df.select(key, order).distinct()
        found = nearest_price(dates, price, key, order, columns, slice_of=slice_of)
        return df.join(found, [key, order], "left").select(*df.columns, "price_date", *columns)

    # New names for the key: the union then reports the partitioning both sides share.
    at = [F.col(key).alias("_key"), F.col(order).alias("_at"), slice_of(F.col(order)).alias("_slice")]
    here = F.struct(F.col(order).alias("price_date"), *[F.col(c) for c in columns])
    prices = price.filter(F.col(order).isNotNull()).select(*at, here.alias("_here"))
    asked = df.select(*at, F.struct(*df.columns).alias("_row"))
    following = F.lead("_here").over(W.partitionBy("_key", "_slice").orderBy("_at"))
    quoted = prices.withColumn("_next", following).select("_key", "_slice", "_at", F.struct("_here", "_next").alias("_quote"))
    filled, ends = slice_edges(prices)
    edges = filled.select("_key", "_slice", F.struct("_before", "_after").alias("_edge"))
    asked = asked.join(ends, "_key", "left").select("_key", "_at", "_slice", "_row", "_ends")
    stream = asked.unionByName(quoted, allowMissingColumns=True).unionByName(edges, allowMissingColumns=True)

    # The edges come first in a slice; on equal dates a price precedes the rows that ask for it.
    stream = stream.withColumn("_place", F.when(F.col("_edge").isNotNull(), 0).when(F.col("_row").isNull(), 1).otherwise(2))
    ordered = W.partitionBy("_key", "_slice").orderBy(F.col("_place") > 0, "_at", "_place")
    so_far = ordered.rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    found = stream.withColumns(
        {
            "_last": F.last("_quote", ignorenulls=True).over(so_far),
            "_first": F.first("_quote", ignorenulls=True).over(whole),
            "_beyond": F.first("_edge", ignorenulls=True).over(whole),
        }
    ).filter(F.col("_row").isNotNull())
    inside = F.when(F.col("_last").isNull(), F.col("_first._here")).otherwise(F.col("_last._next"))
    # Slices before the first price of a key, and after its last, have no edges of their own.
    left = F.when(F.col("_slice") > F.col("_ends.to"), F.col("_ends.last"))
    right = F.when(F.col("_slice") < F.col("_ends.from"), F.col("_ends.first"))
    dated = F.col("_at").isNotNull()
    before = F.when(dated, F.coalesce(F.col("_last._here"), F.col("_beyond._before"), left))
    after = F.when(dated, F.coalesce(inside, F.col("_beyond._after"), right))
    found = found.select("_row", "_at", before.alias("_before"), after.alias("_after"))
    gap_before = day_gap("_at", F.col("_before.price_date"))
    gap_after = day_gap("_at", F.col("_after.price_date"))
    sooner = F.col("_after").isNull() | (gap_before <= gap_after)
    chosen = F.when(sooner, F.col("_before")).otherwise(F.col("_after"))
    return found.select("_row.*", chosen.alias("_chosen")).select(
        *df.columns, "_chosen.price_date", *[f"_chosen.{c}" for c in columns]
    )


def exact_price(
    df: DataFrame, price: DataFrame, adjusted: str = "adj_date", columns: Sequence[str] = ("close",)
) -> DataFrame:
    """Rows with the price of their weekend-adjusted date; others drop out."""
    quotes = price.select("symbol", F.col("date").alias(adjusted), *columns)
    return df.withColumn(adjusted, weekend_roll("date")).join(quotes, ["symbol", adjusted])
