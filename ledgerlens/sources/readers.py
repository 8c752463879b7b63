"""Readers for landed provider files and stored tables."""

from __future__ import annotations

import csv
import re
import warnings
import zlib
from collections.abc import Collection, Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlens import schemas
from ledgerlens.functions.values import clean_ticker
from ledgerlens.operators.normalize import normalize
from ledgerlens.operators.statements import keep_symbols


#: files that are read, plain or compressed
CSV_FILES = "*.{csv,csv.gz}"


def _listed(spark: SparkSession, kind: str, pattern: str = CSV_FILES):
    return spark.read.format(kind).option("recursiveFileLookup", True).option("pathGlobFilter", pattern)


def csv_headers(spark: SparkSession, folder: str, refused: Collection[str] = ()) -> dict[str, list[str]]:
    """Files below a folder by their first line that is not blank.

    Tasks read the lines and send one row for each file; the driver gets each distinct line once,
    with the paths, which Spark's own listing holds there too.  The pass reads every file to its
    end, without skipping faults: it fails on a file that breaks half-way.
    """
    lines = _listed(spark, "text").option("ignoreCorruptFiles", False).load(folder)
    lines = lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    if refused:
        lines = lines.filter(~F.col("path").isin(list(refused)))
    # Lines of a file's first block come in order, in one task.
    lines = lines.filter((F.col("start") == 0) & (F.trim("value") != "")).withColumn("at", F.monotonically_increasing_id())
    first = lines.groupBy("path").agg(F.min_by("value", "at").alias("line"))
    found = first.groupBy("line").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    return {r.line: r.paths for r in found.collect()}


def _ends_early(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths of compressed files (path, content) that do not unpack to their end."""
    for b in batches:
        broken = []
        for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            left, whole = memoryview(content.as_buffer()), True
            while whole and len(left):
                part = zlib.decompressobj(31)
                try:
                    for at in range(0, len(left), 1 << 20):
                        part.decompress(left[at : at + (1 << 20)])
                        if part.eof:
                            break
                    whole = part.eof
                    left = left[min(len(left), at + (1 << 20)) - len(part.unused_data) :]
                except zlib.error:
                    whole = False
            if not whole:
                broken.append(path)
        yield pa.RecordBatch.from_arrays([pa.array(broken, pa.string())], ["path"])


def _broken_files(spark: SparkSession, folder: str, error: Exception, known: Collection[str]) -> set[str]:
    """Files that cannot be read to their end, after a pass has failed on one: all such compressed
    files, found by tasks that unpack them, and the one that the error names."""
    packed = _listed(spark, "binaryFile", "*.csv.gz").load(folder).select("path", "content")
    found = {r.path for r in packed.mapInArrow(_ends_early, "path string").collect()}
    found |= set(re.findall(r"reading file (\S+?)\.? (?:SQLSTATE|\n|$)", str(error)))
    if found <= set(known):
        raise error
    return found


def read_csv_tree(
    spark: SparkSession,
    folder: str,
    table: str | None = None,
    marker: str = "symbol",
    multiline: bool = False,
) -> DataFrame:
    """All ``*.csv`` and ``*.csv.gz`` files below a folder, each by its own header; columns arrive
    as text.

    Files are grouped by header and each layout is read directly, so any number of columns and of
    layouts goes, and headers of any length.  A file without a column ``marker``, or one that
    cannot be read to its end, is refused whole, with a warning that names it.  Quotes are doubled
    inside quoted cells; ``multiline`` allows line breaks there, at the price of one task a file.
    With ``table`` the rows are brought to that table's schema.
    """
    broken: set[str] = set()
    while True:
        try:
            headers = csv_headers(spark, folder, broken)
            break
        except (PySparkException, Py4JJavaError) as error:
            broken |= _broken_files(spark, folder, error, broken)
    layouts: dict[tuple[str, ...], list[str]] = {}
    without = []
    for line, paths in headers.items():
        cells = tuple(cell.strip() for cell in next(csv.reader([line.lstrip("\ufeff")]), []))
        if marker in cells:
            layouts.setdefault(cells, []).extend(paths)
        else:
            without += paths
    for files, fault in ((without, f"without column {marker!r}"), (sorted(broken), "that break off or cannot be read")):
        if files:
            shown = ", ".join(files[:5])
            warnings.warn(f"{len(files)} files {fault} are refused: {shown}", stacklevel=2)
    parts = [_csv_layout(spark, header, paths, multiline) for header, paths in sorted(layouts.items())]
    if not parts:
        parts = [spark.createDataFrame([], StructType([StructField(marker, StringType())]))]
    if table is not None:
        parts = [normalize(part, table) for part in parts]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def _csv_layout(
    spark: SparkSession, header: Sequence[str], paths: Sequence[str], multiline: bool
) -> DataFrame:
    """Files of one header.  Of repeated names the first counts; cells without a name are dropped."""
    places = {name: f"_c{i}" for i, name in reversed(list(enumerate(header))) if name}
    text = StructType([StructField(f"_c{i}", StringType()) for i in range(len(header))])
    rows = (
        spark.read.schema(text)
        .option("header", True)
        .option("enforceSchema", True)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("maxColumns", max(20_480, len(header) + 1))
        .csv(list(paths))
    )
    return rows.select(*[F.btrim(place).alias(name) for name, place in reversed(places.items())])


def seed_companies(statements: DataFrame) -> DataFrame:
    """Distinct symbols of a statement set; the scan reads only that column."""
    return statements.select("symbol").filter(F.col("symbol").isNotNull()).distinct()


def _text_schema(table: str) -> StructType:
    """Provider schema with every column as text, so that a bad value costs one cell."""
    names = [f.name for f in schemas.provider_schema(table).fields]
    return StructType([StructField(n, StringType()) for n in names])


def read_json_records(
    spark: SparkSession, path: str, table: str, multiline: bool = True
) -> DataFrame:
    """Provider responses, each an array of flat records, as rows of ``table``.

    ``multiline`` takes one response per file, otherwise one per line, which splits
    large files over many tasks.
    """
    raw = (
        spark.read.schema(_text_schema(table))
        .option("multiLine", multiline)
        .option("recursiveFileLookup", True)
        .json(path)
    )
    return normalize(raw, table)


def read_ticker_json(
    spark: SparkSession, path: str, backup: str | None = None, whole_file: bool = True
) -> DataFrame:
    """Tickers of an object of objects ``{"0": {"ticker": ...}, ...}``.

    ``backup`` is read if the first path does not exist.  ``whole_file=False`` takes one
    document per line.
    """
    try:
        text = spark.read.text(path, wholetext=whole_file)
    except AnalysisException:
        if backup is None:
            raise
        warnings.warn(f"{path} cannot be read, using {backup}", stacklevel=2)
        text = spark.read.text(backup, wholetext=whole_file)
    entries = F.from_json("value", "map<string,struct<ticker:string>>")
    return text.select(F.explode(entries).alias("_key", "_entry")).select(
        F.col("_entry.ticker").alias("symbol")
    )


def read_ticker_list(
    spark: SparkSession, path: str | None = None, extra: Iterable[str] = ()
) -> DataFrame | None:
    """Tickers of a file (one per line, blanks ignored) and of ``extra``, upper-cased.

    None when neither is given: the caller then takes every company.
    """
    extra = list(extra)
    parts = []
    if extra:
        parts.append(spark.createDataFrame([(s,) for s in extra], "symbol string"))
    if path is not None:
        parts.append(spark.read.text(path).select(F.col("value").alias("symbol")))
    if not parts:
        return None
    listed = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return listed.select(clean_ticker("symbol").alias("symbol")).filter("symbol <> ''")


def scan_table(
    spark: SparkSession, path: str, symbols: Collection[str] | DataFrame | None = None
) -> DataFrame:
    """A stored parquet table, restricted to some symbols."""
    return keep_symbols(spark.read.parquet(path), symbols)
