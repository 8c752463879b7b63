"""Continuous ingest: landed files are upserted as they arrive.

Each commit keeps the id of the stream, which its checkpoint holds, and the number of the batch.  A
batch that is replayed, because a run died after the commit and before the checkpoint, is
recognised by that before any work and left out.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ledgerlens import schemas
from ledgerlens.operators.ingest import ingest
from ledgerlens.sources.store import VersionedStore


def stream_id(store: VersionedStore, checkpoint: str) -> str:
    """Id of the stream that a checkpoint belongs to; a new checkpoint, at the same path too, is a
    new stream."""
    rows = store.spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect()
    return json.loads("".join(r.value for r in rows))["id"]


def _taking(store: VersionedStore, checkpoint: str, raw: Callable[[VersionedStore, DataFrame, str], Mapping[str, DataFrame]]):
    """What a stream does with a batch: commit its tables once.  ``raw`` may stage rows for the run
    it is given."""

    def upsert_files(batch: DataFrame, batch_id: int) -> None:
        own = VersionedStore(batch.sparkSession, store.root, store.buckets)
        stream = stream_id(own, checkpoint)
        if own.head().streams.get(stream, -1) < batch_id:
            run = own.new_run()
            if tables := raw(own, batch, run):
                ingest(own, tables, source=(stream, batch_id))
            own.drop_staging(run)

    return upsert_files


def stream_upsert(
    store: VersionedStore,
    landing: str,
    table: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
):
    """Upsert the files that landed since the last run, then stop.

    Files hold provider records as JSON, one record or one array a line.  The checkpoint
    gives each file to one micro-batch, and the store takes each batch once.  Rows of one key are ordered by the time and name of their
    files, so the result does not depend on the number of files a batch.  Returns the finished
    query.
    """
    names = [f.name for f in schemas.provider_schema(table).fields]
    text = StructType([StructField(n, StringType()) for n in names])
    reader = store.spark.readStream.schema(text)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    at, file = schemas.LANDING
    query = (
        reader.json(landing)
        .select("*", F.col("_metadata.file_modification_time").alias(at), F.col("_metadata.file_path").alias(file))
        .writeStream.foreachBatch(_taking(store, checkpoint, lambda own, batch, run: {table: batch}))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def stream_upsert_all(
    store: VersionedStore,
    landing: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
):
    """Upsert the files of all tables that landed since the last run, then stop.

    ``landing`` has a folder for each stored table, by its name, with files as
    ``stream_upsert`` takes them; files of other folders are left alone.  One stream reads them
    all, and each micro-batch is one commit for all of its tables.  Returns the finished query.
    """
    at, file = schemas.LANDING
    reader = store.spark.readStream.option("recursiveFileLookup", True)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    folder = F.regexp_extract(F.col("_metadata.file_path"), "/([^/]+)/[^/]+$", 1)
    lines = reader.text(landing).select(
        "value",
        folder.alias("table_name"),
        F.col("_metadata.file_modification_time").alias(at),
        F.col("_metadata.file_path").alias(file),
    )

    def records(rows: DataFrame, table: str) -> DataFrame:
        names = [f.name for f in schemas.provider_schema(table).fields]
        one = StructType([StructField(n, StringType()) for n in names])
        return rows.select(F.inline(F.from_json("value", ArrayType(one))), at, file)

    def landed(own: VersionedStore, batch: DataFrame, run: str) -> dict[str, DataFrame]:
        # The files are read once, and each table then parses its own lines alone.
        known = [t for t in schemas.TABLES if t != "shares_fy"]
        staged = own.stage_parts("landed", batch.filter(F.col("table_name").isin(known)), run, "table_name")
        return {t: records(staged[t], t) for t in known if t in staged}

    query = (
        lines.writeStream.foreachBatch(_taking(store, checkpoint, landed))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
