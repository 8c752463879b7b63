"""Helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import work_folder

#: Rows that go to a Python worker at once; texts reach a hundred kilobytes.
ARROW_ROWS = 512
#: Rows of a side that may be broadcast; the sides it is used for are some tens of bytes wide.
BROADCAST_ROWS = 20_000
#: Characters of texts that a worker takes at once.
CHARACTERS = 2_000_000
#: The ASCII white space that separates words.
WORD = r"[^\x20\x09-\x0D]+"


def session_of(df: DataFrame) -> SparkSession:
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return df.sparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, row_group: int | None = None) -> DataFrame:
    """Write to the shared folder and read back: later jobs start from the files, so a lost
    executor costs one task and no earlier stage.  ``row_group``: bytes that a reader takes at
    once, for rows of a megabyte."""
    spark = df.sparkSession
    path = work_folder(spark, label)
    write = df.write.option("parquet.block.size", row_group) if row_group else df.write
    write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_join(df: DataFrame, side: DataFrame, on: Sequence[str], how: str = "inner", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join with a stored side: broadcast where its row count is at most ``rows``, else an
    equi-join whose hot keys Spark splits at run time."""
    few = side.limit(rows + 1).count() <= rows
    return df.join(F.broadcast(side) if few else side, list(on), how)


def held_out(id_column: str, modulus: int, rest: int) -> Column:
    """Whether crc32 of the id, written as text, leaves ``rest``; a null id is never held out."""
    of = F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus == rest
    return F.coalesce(of, F.lit(False))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores before it until no column has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def pieces(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """Texts in order, at most ``CHARACTERS`` at a time or a single one."""
    part, size = [], 0
    for t in texts:
        t = t or ""
        if part and size + len(t) > CHARACTERS:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part
