"""Work folder and session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


# Settings the plans are written for.  Tables are bucketed by symbol and joined on symbol
# and date; with the first setting such a join keeps the buckets instead of shuffling both
# sides by all keys.  A symbol's rows are bounded by the calendar, so this adds no skew.
# The second lets a scan of one sorted file per bucket stand for the sort of a merge join
# or window.
SQL_SETTINGS = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings; they can be changed at run time and need no new session."""
    for name, value in SQL_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_root(spark: SparkSession) -> str | None:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Where the setting is missing a temporary folder is made, but only in local mode,
    where the driver is the only machine.  On a cluster without the setting: None.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        return None
    app = spark.conf.get("spark.app.id", "local")
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="ledgerlens-")
    return _LOCAL_ROOTS[app]


def work_folder(spark: SparkSession, label: str) -> str:
    """New path, not used before, below the shared root."""
    root = shared_root(spark)
    if root is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{root}/ledgerlens/{label}-{uuid.uuid4().hex[:12]}"
