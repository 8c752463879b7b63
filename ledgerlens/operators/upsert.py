"""Field-level upsert of a batch into stored rows.

One outer join on the merge keys carries everything: classification, changed cells,
the merged row and the change log are projections of it.  Nothing is ever deleted:
stored rows missing in the batch stay as they are.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.values import differs
from ledgerlens.operators.manifest import first_row_per_key

INSERT, UPDATE, SAME = "insert", "update", "same"
#: columns that tell a restated statement from an older one, most telling first
FILING_DATES = ("accepteddate", "fillingdate")


def dedup_batch(batch: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key.

    The first by ``order``; further columns break ties, so the choice does not depend
    on partitioning.
    """
    rest = [c for c in batch.columns if c not in {*keys, *order}]
    return first_row_per_key(batch, keys, [*order, *rest] or list(keys))


def latest_cells(batch: DataFrame, keys: Sequence[str], landing: Sequence[str] = ()) -> DataFrame:
    """One row per key: for each cell the last value that is not NULL.

    Rows are ordered by the ``landing`` columns (dropped from the result), then by the dates a
    statement was filed on, then by a hash of their values.  This is what applying the rows one
    after another gives, so it does not matter how they are cut into batches.  Maxima combine on
    the map side: a key with very many rows does not meet in one task.
    """
    columns = [c for c in batch.columns if c not in landing]
    values = [c for c in columns if c not in keys]
    if not values:
        return batch.select(*keys).distinct()
    if len(landing) > 1:
        batch, landing = _ranked(batch, landing), ["_rank"]
    filed = [c for c in FILING_DATES if c in values]
    place = F.struct(*landing, *filed, F.xxhash64(*values).alias("_hash"))
    cells = [F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in values]
    return batch.groupBy(*keys).agg(*cells).select(*columns)


def _ranked(batch: DataFrame, landing: Sequence[str]) -> DataFrame:
    """The batch with the rank of its rows' file in place of time and name: every cell of a group
    carries its place, and a path is many times a number.  There is one rank for each file of the
    batch, which the stream lists on the driver too."""
    names = [f"_of{c}" for c in landing]
    files = batch.select(*landing).distinct().toDF(*names)
    files = files.withColumn("_rank", F.row_number().over(Window.orderBy(*names)))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(landing, names, strict=True)])
    return batch.join(F.broadcast(files), same).drop(*landing, *names)


def filled_columns(batches: Mapping[str, DataFrame], kept: Mapping[str, Collection[str]]) -> dict[str, DataFrame]:
    """The batches without columns that are NULL in every row, but for those of ``kept``: they
    change no cell.  One pass over all batches."""

    def filled(table: str, batch: DataFrame) -> DataFrame:
        maybe = [c for c in batch.columns if c not in kept[table]]
        there = [F.when(F.bool_or(F.col(c).isNotNull()), F.lit(c)) for c in maybe]
        return batch.agg(F.lit(table).alias("table_name"), F.array_compact(F.array(*there, F.lit(""))).alias("names"))

    found = reduce(DataFrame.unionByName, [filled(t, b) for t, b in batches.items()]).collect()
    names = {r.table_name: {*r.names, *kept[r.table_name]} for r in found}
    return {t: b.select(*[c for c in b.columns if c in names[t]]) for t, b in batches.items()}


def _value_columns(batch: DataFrame, stored: DataFrame, keys: Sequence[str]) -> list[str]:
    known = set(stored.columns)
    return [c for c in batch.columns if c in known and c not in keys]


def _pair(batch: DataFrame, stored: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join batch (struct ``n``) to stored rows (struct ``o``) on the keys."""
    new = batch.select(*keys, F.struct(*batch.columns).alias("n"))
    old = stored.select(*keys, F.struct(*stored.columns).alias("o"))
    return new.join(old, list(keys), how)


def _changed(batch: DataFrame, column: str) -> Column:
    return differs(F.col(f"n.{column}"), F.col(f"o.{column}"), batch.schema[column].dataType)


def classify(batch: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch with column ``op``: insert, update or same."""
    values = _value_columns(batch, stored, keys)
    touched = F.lit(False)
    for c in values:
        touched = touched | _changed(batch, c)
    op = F.when(F.col("o").isNull(), INSERT).when(touched, UPDATE).otherwise(SAME)
    return _pair(batch, stored, keys, "left").select("n.*", op.alias("op"))


def inserts(batch: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key is not stored."""
    return batch.join(stored.select(*keys), list(keys), "left_anti")


def update_set(batch: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys and changed cells of the rows with at least one change.

    An unchanged cell is NULL; ``changed_columns`` lists the changed ones.
    """
    values = _value_columns(batch, stored, keys)
    cells = [F.when(_changed(batch, c), F.col(f"n.{c}")).alias(c) for c in values]
    names = F.array_compact(F.array(*[F.when(_changed(batch, c), F.lit(c)) for c in values]))
    return (
        _pair(batch, stored, keys, "inner")
        .select(*keys, *cells, names.alias("changed_columns"))
        .filter(F.size("changed_columns") > 0)
    )


def _merged_cells(batch: DataFrame, stored: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The stored columns after the upsert, of a joined pair."""
    values = set(_value_columns(batch, stored, keys))

    def merged(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c not in values:
            return F.col(f"o.{c}").alias(c)
        taken = F.when(F.col("o").isNull() | _changed(batch, c), F.col(f"n.{c}"))
        return F.coalesce(taken, F.col(f"o.{c}")).alias(c)

    return [merged(c) for c in stored.columns]


def apply_batch(batch: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows after the upsert: the batch must hold each key once.

    Columns only the stored table has keep their value (NULL on inserted rows).
    """
    return _pair(batch, stored, keys, "full").select(*_merged_cells(batch, stored, keys))


def apply_and_tell(batch: DataFrame, stored: DataFrame, keys: Sequence[str], op: str, changed: str) -> DataFrame:
    """``apply_batch`` with two more columns: ``op`` is insert or update, NULL on rows that stay as
    they are, and ``changed`` lists the changed columns of an update.  One join gives both."""
    names = F.array_compact(F.array(*[F.when(_changed(batch, c), F.lit(c)) for c in _value_columns(batch, stored, keys)]))
    is_new = F.col("o").isNull()
    differs_from_old = F.col("n").isNotNull() & (F.size(names) > 0)
    return _pair(batch, stored, keys, "full").select(
        *_merged_cells(batch, stored, keys),
        F.when(is_new, INSERT).when(differs_from_old, UPDATE).alias(op),
        F.when(~is_new & differs_from_old, names.cast("array<string>")).alias(changed),
    )


def change_log(
    batch: DataFrame, stored: DataFrame, keys: Sequence[str], table: str
) -> DataFrame:
    """One row per inserted or updated key with the names of the changed columns."""
    values = _value_columns(batch, stored, keys)
    names = F.array_compact(F.array(*[F.when(_changed(batch, c), F.lit(c)) for c in values]))
    is_new = F.col("o").isNull()
    return (
        _pair(batch, stored, keys, "left")
        .select(
            F.lit(table).alias("table_name"),
            *keys,
            F.when(is_new, INSERT).otherwise(UPDATE).alias("op"),
            F.when(~is_new, names).alias("changed_columns"),
        )
        .filter((F.col("op") == INSERT) | (F.size("changed_columns") > 0))
    )


def update_by_symbol(
    df: DataFrame, column: str, values: DataFrame, value_column: str = "value"
) -> DataFrame:
    """Set ``column`` for the symbols listed in ``values`` (symbol, value).

    Adds ``updated`` so that the affected rows can be counted.  Each symbol must be
    listed once.
    """
    new = values.select(
        F.col("symbol"),
        F.col(value_column).cast(df.schema[column].dataType).alias("_value"),
        F.lit(True).alias("_hit"),
    )
    hit = F.col("_hit").isNotNull()
    cells = [
        F.when(hit, F.col("_value")).otherwise(F.col(c)).alias(c) if c == column else F.col(c)
        for c in df.columns
    ]
    return df.join(new, "symbol", "left").select(*cells, hit.alias("updated"))
