"""Writers: append, one folder per key, bucketed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append_rows(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Append rows to a parquet table."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_csv_per_symbol(df: DataFrame, path: str, key: str = "symbol") -> None:
    """One CSV folder per key.

    Rows are first brought together by key, so a key gets one file and a task keeps
    one file open at a time.  The time goes to files and not to bytes, so the number of tasks
    is fixed: by their bytes, small exchanges would be joined to one task that writes all files.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        df.repartition(tasks, key)
        .write.mode("errorifexists")
        .partitionBy(key)
        .option("header", True)
        .csv(path)
    )


#: symbols per bucket of a bucketed table: about half a gigabyte of quarterly rows
SYMBOLS_PER_BUCKET = 100_000
#: rows per bucket of a bucketed table: one task sorts, joins or windows them in some hundred megabytes
ROWS_PER_BUCKET = 500_000
MIN_BUCKETS, MAX_BUCKETS = 8, 16_384


def bucket_count(symbols: int, rows: int = 0) -> int:
    """Number of buckets for a number of symbols, and of rows of the largest table where it is known."""
    return min(max(-(-symbols // SYMBOLS_PER_BUCKET), -(-rows // ROWS_PER_BUCKET), MIN_BUCKETS), MAX_BUCKETS)


def write_bucketed(
    df: DataFrame,
    name: str,
    path: str,
    buckets: int,
    key: str = "symbol",
    sort: Sequence[str] = (),
) -> DataFrame:
    """Write a table bucketed by ``key`` and sorted by key and ``sort``, one file per bucket.

    Tables of the same key and bucket count join, window and aggregate on the key
    without a shuffle (and without a sort where the order fits), and a filter on the
    key reads one bucket.
    """
    spark: SparkSession = df.sparkSession
    (
        df.repartition(buckets, F.col(key))
        .write.format("parquet")
        .mode("errorifexists")
        .bucketBy(buckets, key)
        .sortBy(key, *sort)
        .option("path", path)
        .saveAsTable(name)
    )
    return spark.table(name)
