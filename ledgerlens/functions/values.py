"""Small value expressions used by normalisation and the upsert."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, IntegralType

#: decimals at which floating-point values count as equal
COMPARE_DECIMALS = 4
#: below this both values count as zero-like and are compared by distance
TINY = 1e-10


def clean_ticker(column: Column | str) -> Column:
    """Upper-case, without surrounding blanks, tabs or line ends."""
    return F.upper(F.btrim(column, F.lit(" \t\r\n")))


def is_floating(dtype: DataType) -> bool:
    return isinstance(dtype, (DoubleType, FloatType))


def null_if_nan(column: Column | str) -> Column:
    col = F.col(column) if isinstance(column, str) else column
    return F.when(~F.isnan(col), col)


def differs(new: Column, old: Column, dtype: DataType) -> Column:
    """True where a stored value must be replaced by the new one.

    A missing new value never replaces; a missing old value is always filled.
    Floating-point values are compared at four decimals, all other types exactly.
    """
    if is_floating(dtype):
        tiny = (F.abs(new) < TINY) & (F.abs(old) < TINY)
        unequal = F.when(tiny, F.abs(new - old) > TINY).otherwise(
            F.round(new, COMPARE_DECIMALS) != F.round(old, COMPARE_DECIMALS)
        )
    else:
        unequal = new != old
    return new.isNotNull() & (old.isNull() | unequal)


def parse_date(text: Column) -> Column:
    """``yyyy-MM-dd`` or ``yyyy-MM-dd HH:mm:ss`` text as a date, else NULL."""
    stamp = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")).cast("date")
    return F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), stamp)


def parse_timestamp(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text as a timestamp without zone, else NULL."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def try_value(column: Column, source: DataType, target: DataType) -> Column:
    """Cast to the declared type; a value that does not fit becomes NULL."""
    if source == target:
        return column
    kind, is_text = target.simpleString(), source.simpleString() == "string"
    if is_text and kind == "date":
        return parse_date(column)
    if is_text and kind == "timestamp_ntz":
        return parse_timestamp(column)
    if is_text and isinstance(target, IntegralType):
        # Integers may be spelt as floats ("123.0", "1.2E9"); a decimal keeps all digits.
        wide = column.try_cast(DecimalType(38, 6)).try_cast(target)
        return F.coalesce(column.try_cast(target), wide)
    return column.try_cast(target)
