"""Bring a provider batch to a declared table schema."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ledgerlens import schemas
from ledgerlens.functions.values import is_floating, null_if_nan, try_value


def rename_lower(df: DataFrame) -> DataFrame:
    """Provider camelCase names to stored lower-case names."""
    return df.toDF(*[c.lower() for c in df.columns])


def project_declared(
    df: DataFrame, table: str, fill_missing: bool = True, keep: Collection[str] = ()
) -> DataFrame:
    """Keep the declared columns only, and those of ``keep`` that are there.

    A declared column not in the batch is NULL, or left out without ``fill_missing``.
    """
    present = set(df.columns)
    return df.select(
        *[
            F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schemas.table_schema(table).fields
            if f.name not in schemas.SURROGATES and (fill_missing or f.name in present)
        ],
        *[c for c in keep if c in present],
    )


def cast_declared(df: DataFrame, table: str) -> DataFrame:
    """Cast each column to its declared type; bad values become NULL."""
    declared = {f.name: f.dataType for f in schemas.table_schema(table).fields}
    return df.select(
        *[
            try_value(F.col(f.name), f.dataType, declared[f.name]).alias(f.name)
            if f.name in declared
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating-point columns becomes NULL."""
    return df.select(
        *[
            null_if_nan(f.name).alias(f.name) if is_floating(f.dataType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def add_columns(df: DataFrame, columns: Mapping[str, str | DataType]) -> DataFrame:
    """Add the columns that are missing, as typed NULLs; existing ones stay."""
    present = {c.lower() for c in df.columns}
    return df.withColumns(
        {c: F.lit(None).cast(t) for c, t in columns.items() if c.lower() not in present}
    )


def normalize(
    df: DataFrame, table: str, fill_missing: bool = True, keep: Collection[str] = ()
) -> DataFrame:
    """Rename, project, cast and clear NaN: one narrow projection over the batch."""
    projected = project_declared(rename_lower(df), table, fill_missing, keep)
    return nan_to_null(cast_declared(projected, table))
