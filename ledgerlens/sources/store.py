"""Versioned parquet tables with one commit file for all of them.

Tables are split in cells: a bucket of symbols and a year.  A run writes the touched cells of
every table to a new version folder and then one small commit that names, per table and cell, the
version to read.  Readers see the tables of one commit only: a run that fails half-way is
invisible.

A commit is written whole under a name of its own and then published by a rename that never
overwrites, so a number is taken once and a commit is never seen in part.  It carries its length
and checksum: a damaged one is refused with a warning, and the commit before it counts.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
import warnings
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens.sources.writers import MIN_BUCKETS

#: bucket and year
Cell = tuple[int, int]
#: per table and cell, the run whose files hold its rows
Layout = dict[str, dict[Cell, str]]

#: the layout of commit files; others are refused
FORMAT = 2
#: what parts the name of a run from the number of its attempt, in the names of versions
ATTEMPT = "~"
#: columns that files of a version hold beside the table's: what the run did with the row
OP, CHANGED = "_op", "_changed_columns"
CHANGE_SCHEMA = "table_name string, symbol string, key string, op string, changed_columns array<string>, bucket int, year int"


class CommitConflict(Exception):
    """Another run committed the same number first."""


class StoreDamaged(Exception):
    """There are commits, but none can be read."""


@dataclass
class Commit:
    """A published state: ``free`` is the number the next commit tries, ``streams`` the last batch
    taken from each stream, ``changes`` the folder of the run's change log."""

    number: int = 0
    layout: Layout = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)
    run: str | None = None
    changes: str | None = None
    free: int = 1


def cell_year(table: str) -> Column:
    """Year of a row's cell, from columns of its merge key, so that an update never moves a row."""
    names = schemas.table_schema(table).names
    if "calendaryear" in names:
        return F.col("calendaryear").cast("int")
    return F.year("date") if "date" in names else F.lit(0)


class VersionedStore:
    """Tables below ``root``, split in ``buckets`` by a hash of the symbol, and by year."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = MIN_BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    def bucket_of(self, symbol: Column | str = "symbol") -> Column:
        return F.pmod(F.hash(symbol), F.lit(self.buckets)).cast("int")

    # --- files ---------------------------------------------------------------------------

    def _hadoop(self, path: str):
        """The file system of a path, and the path as it takes it."""
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _names(self, folder: str) -> list[str]:
        fs, at = self._hadoop(f"{self.root}/{folder}")
        return [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []

    def _delete(self, path: str) -> None:
        fs, at = self._hadoop(f"{self.root}/{path}")
        fs.delete(at, True)

    def _publish(self, path: str, head: Mapping, body: bytes = b"") -> None:
        """Make a file visible whole, under a name that is not taken yet."""
        head = {**head, "format": FORMAT, "bytes": len(body), "sha256": hashlib.sha256(body).hexdigest()}
        fs, at = self._hadoop(f"{self.root}/{path}")
        hidden = self.spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{uuid.uuid4().hex}.tmp")
        out = fs.create(hidden, False)
        try:
            out.write(bytearray(json.dumps(head, sort_keys=True).encode() + b"\n" + body))
        finally:
            out.close()
        try:
            self._rename(fs, hidden, at)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception) or fs.exists(at):
                raise CommitConflict(path) from error
            raise
        finally:
            fs.delete(hidden, False)

    def _rename(self, fs, source, target) -> None:
        """Rename without overwriting.  A local file system would check first and rename then, so
        there a link takes the name, which fails if it is taken."""
        jvm = self.spark._jvm
        if fs.getScheme() == "file":
            old, new = (jvm.java.io.File(p.toUri().getPath()).toPath() for p in (source, target))
            try:
                jvm.java.nio.file.Files.createLink(new, old)
                return
            except Py4JJavaError as error:
                if "UnsupportedOperation" not in str(error.java_exception):
                    raise
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark._sc._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(source, target, options)

    def _published(self, path: str) -> tuple[dict, bytes] | None:
        """Head and body of a published file, None if it is torn, damaged or of another format."""
        fs, at = self._hadoop(f"{self.root}/{path}")
        try:
            stream = fs.open(at)
            try:
                text = bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
            finally:
                stream.close()
            first, _, body = text.partition(b"\n")
            head = json.loads(first)
            whole = head["format"] == FORMAT and head["bytes"] == len(body) and head["sha256"] == hashlib.sha256(body).hexdigest()
        except (Py4JError, ValueError, KeyError, TypeError):
            return None
        return (head, body) if whole else None

    def _numbers(self, folder: str, suffix: str = ".json") -> list[int]:
        stems = [n.removesuffix(suffix) for n in self._names(folder) if n.endswith(suffix)]
        return sorted(int(s) for s in stems if s.isdigit())

    # --- commits -------------------------------------------------------------------------

    def commit_at(self, number: int) -> Commit | None:
        """A commit, None if its file cannot be read; bounded by tables times cells."""
        found = self._published(f"_commits/{number:010d}.json")
        if found is None:
            return None
        head, body = found
        layout: Layout = {}
        for line in body.decode().splitlines():
            table, bucket, year, version = json.loads(line)
            layout.setdefault(table, {})[bucket, year] = version
        return Commit(number, layout, head["streams"], head["run"], head["changes"], number + 1)

    def head(self) -> Commit:
        """The newest commit that can be read.  Damaged ones after it are named in a warning and
        left alone; the next commit goes behind them."""
        numbers = self._numbers("_commits")
        damaged = []
        for number in reversed(numbers):
            commit = self.commit_at(number)
            if commit is not None:
                commit.free = numbers[-1] + 1
                if damaged:
                    shown = ", ".join(map(str, damaged[:5]))
                    warnings.warn(f"commits {shown} of {self.root} cannot be read; commit {number} counts", stacklevel=3)
                return commit
            damaged.append(number)
        if damaged or self._numbers("_commits", ".head"):
            raise StoreDamaged(f"no commit of {self.root} can be read")
        return Commit()

    def current(self) -> tuple[int, Layout]:
        """Number and layout of the newest commit."""
        commit = self.head()
        return commit.number, commit.layout

    def layout_at(self, number: int) -> Layout:
        commit = self.commit_at(number)
        if commit is None:
            raise StoreDamaged(f"commit {number} of {self.root} cannot be read")
        return commit.layout

    def commit(
        self, base: Commit, written: Mapping[str, Iterable[Cell]], run: str,
        streams: Mapping[str, int] | None = None, changes: str | None = None,
    ) -> int:
        """Make the written cells visible on top of ``base``, all tables at once, with the batches
        taken from ``streams`` and the folder of the change log.

        Raises ``CommitConflict`` if another run was first.
        """
        merged = {t: dict(cells) for t, cells in base.layout.items()}
        for table, cells in written.items():
            merged.setdefault(table, {}).update({c: run for c in cells})
        lines = [json.dumps([t, *cell, v]) for t, cells in sorted(merged.items()) for cell, v in sorted(cells.items())]
        head = {"commit": base.free, "run": run, "changes": changes, "streams": {**base.streams, **(streams or {})}}
        self._publish(f"_commits/{base.free:010d}.json", head, "".join(f"{x}\n" for x in lines).encode())
        return base.free

    def heads(self, after: int = 0, upto: int | None = None) -> list[dict]:
        """Heads of the commits with numbers above ``after`` up to ``upto``, vacuumed ones included."""
        found = {}
        for suffix in (".head", ".json"):
            for n in self._numbers("_commits", suffix):
                if n > after and (upto is None or n <= upto):
                    at = self._published(f"_commits/{n:010d}{suffix}")
                    if at is not None:
                        found[n] = {**at[0], "commit": n}
        return [found[n] for n in sorted(found)]

    def reserve_ids(self, count: int) -> int:
        """First of ``count`` company ids that no other run gets.  A run that fails leaves a gap."""
        while True:
            numbers = self._numbers("_ids")
            last = self._published(f"_ids/{numbers[-1]:010d}.json") if numbers else ({"to": 0}, b"")
            if last is None:
                raise StoreDamaged(f"id range {numbers[-1]} of {self.root} cannot be read")
            first = last[0]["to"] + 1
            try:
                free = numbers[-1] + 1 if numbers else 1
                self._publish(f"_ids/{free:010d}.json", {"from": first, "to": first + count - 1})
                return first
            except CommitConflict:
                continue

    # --- tables --------------------------------------------------------------------------

    def read(
        self,
        table: str,
        buckets: Iterable[int] | None = None,
        layout: Layout | None = None,
        years: Iterable[int] | None = None,
        cells: Iterable[Cell] | None = None,
    ) -> DataFrame:
        """Rows of the table at the newest (or given) layout, optionally of some buckets, years or
        cells only: files of others are not even listed."""
        if layout is None:
            _, layout = self.current()
        wanted = layout.get(table, {})
        if cells is not None:
            wanted = {c: wanted[c] for c in cells if c in wanted}
        if buckets is not None:
            keep = set(buckets)
            wanted = {c: v for c, v in wanted.items() if c[0] in keep}
        if years is not None:
            of = set(years)
            wanted = {c: v for c, v in wanted.items() if c[1] in of}
        schema = schemas.table_schema(table)
        if not wanted:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{table}/version={v}/bucket={b}/year={y}" for (b, y), v in sorted(wanted.items())]
        return self.spark.read.schema(schema).parquet(*paths)

    def read_symbol(self, table: str, symbol: str, years: Iterable[int] | None = None) -> DataFrame:
        """One symbol's rows: a single bucket is listed and read."""
        bucket = self.spark.range(1).select(self.bucket_of(F.lit(symbol))).first()[0]
        return self.read(table, [bucket], years=years).filter(F.col("symbol") == symbol)

    def read_symbols(
        self, table: str, symbols: Iterable[str] | DataFrame, years: Iterable[int] | None = None
    ) -> DataFrame:
        """Rows of some symbols, a list or a DataFrame with a column symbol: only files of their
        buckets, and of the given years, are listed and read."""
        if not isinstance(symbols, DataFrame):
            symbols = self.spark.createDataFrame([(s,) for s in symbols], "symbol string")
        wanted = symbols.select("symbol").distinct()
        buckets = [r.bucket for r in wanted.select(self.bucket_of().alias("bucket")).distinct().collect()]
        return self.read(table, buckets, years=years).join(wanted, "symbol", "left_semi")

    def put(self, table: str, df: DataFrame) -> int:
        """Write the rows of a whole table, whose keys are unique, in a commit of their own; cells
        that ``df`` touches are replaced."""
        run, base = self.new_run(), self.head()
        cells = self.touched({table: df})
        self.write_version(table, df, run, max(1, len(cells.get(table, []))))
        return self.commit(base, cells, run)

    def publish(self, table: str, name: str) -> DataFrame:
        """The newest commit's rows as table ``name`` of the catalog, bucketed by symbol and
        partitioned by year, so that scans prune, and joins and windows need no exchange.

        Only years with a cell that changed since the last time are written again.  A refresh
        replaces partitions one after another, so it is for a time without readers.
        """
        folder = f"_published/{name}"
        numbers = self._numbers(folder)
        last = self._published(f"{folder}/{numbers[-1]:010d}.json") if numbers else None
        before = {(b, y): v for b, y, v in json.loads(last[1])} if last else {}
        now = self.current()[1].get(table, {})
        years = sorted({c[1] for c in {*before, *now} if before.get(c) != now.get(c)})
        schema = schemas.table_schema(table)
        order = [c for c in ("symbol", "date") if c in schema.names]
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}, year INT) USING parquet PARTITIONED BY (year) CLUSTERED BY (symbol) "
                f"SORTED BY ({', '.join(order)}) INTO {self.buckets} BUCKETS LOCATION '{self.root}/{folder}/data'"
            )
        if years:
            rows = self.read(table, years=years, layout={table: now}).withColumn("year", cell_year(table))
            rows = rows.repartition(self.buckets, "symbol").sortWithinPartitions("year", *order)
            mode = "spark.sql.sources.partitionOverwriteMode"
            kept = self.spark.conf.get(mode)
            self.spark.conf.set(mode, "dynamic")  # other years stay
            try:
                rows.write.mode("overwrite").insertInto(name)
            finally:
                self.spark.conf.set(mode, kept)
            body = json.dumps([[b, y, v] for (b, y), v in sorted(now.items())]).encode()
            self._publish(f"{folder}/{numbers[-1] + 1 if numbers else 1:010d}.json", {"table": table}, body)
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def touched(self, batches: Mapping[str, DataFrame]) -> dict[str, list[Cell]]:
        """Cells each batch falls in; at most tables times cells rows reach the driver."""
        parts = [
            b.select(F.lit(t).alias("table_name"), self.bucket_of().alias("bucket"), cell_year(t).alias("year")).distinct()
            for t, b in batches.items()
        ]
        found: dict[str, list[Cell]] = {}
        for row in reduce(DataFrame.unionByName, parts).collect():
            found.setdefault(row.table_name, []).append((row.bucket, row.year))
        return {t: sorted(cells) for t, cells in found.items()}

    def new_run(self) -> str:
        """Name of a run, its own also among runs at the same time."""
        return f"{int(time.time() * 1000):014d}-{uuid.uuid4().hex[:8]}"

    def stage(self, name: str, df: DataFrame, run: str) -> DataFrame:
        """Write an intermediate result beside the tables and read it back.

        Later steps scan typed columns instead of parsing the raw files again, and a
        lost executor costs a re-read, not a recomputation.
        """
        return self._written(f"{self.root}/_staging/run={run}/{name}", df)

    def stage_parts(self, name: str, df: DataFrame, run: str, by: str) -> dict[str, DataFrame]:
        """The same in a folder for each value of the text column ``by``; rows by value, without it."""
        folder = f"_staging/run={run}/{name}"
        df.write.mode("overwrite").partitionBy(by).parquet(f"{self.root}/{folder}")
        schema = df.drop(by).schema
        values = [n.removeprefix(f"{by}=") for n in self._names(folder) if n.startswith(f"{by}=")]
        return {v: self.spark.read.schema(schema).parquet(f"{self.root}/{folder}/{by}={v}") for v in values}

    def record(self, name: str, df: DataFrame, run: str) -> DataFrame:
        """Write a result of a run that stays, such as its status."""
        return self._written(f"{self.root}/_runs/run={run}/{name}", df)

    def _written(self, path: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_staging(self, run: str) -> None:
        self._delete(f"_staging/run={run}")

    def write_version(self, table: str, df: DataFrame, run: str, tasks: int) -> None:
        """Write cells of a table as a new, not yet visible version, one file a cell.

        ``df`` may hold ``OP`` and ``CHANGED`` beside the table's columns; ``read`` skips them.
        """
        order = [c for c in ("symbol", "date") if c in df.columns]
        (
            df.withColumns({"bucket": self.bucket_of(), "year": cell_year(table)})
            .repartition(tasks, "bucket", "year")
            .sortWithinPartitions("bucket", "year", *order)
            .write.mode("overwrite")
            .partitionBy("bucket", "year")
            .parquet(f"{self.root}/{table}/version={run}")
        )

    def changes_of(self, table: str, run: str, keys: Iterable[str]) -> DataFrame:
        """Rows that a run inserted or updated, from the files of its version: the columns of
        ``CHANGE_SCHEMA``.  Only keys and the two columns of the change are read."""
        schema = schemas.table_schema(table)
        wanted = [f"{k} {schema[k].dataType.simpleString()}" for k in keys]
        text = ", ".join([*wanted, f"{OP} string", f"{CHANGED} array<string>", "bucket int", "year int"])
        rows = self.spark.read.schema(text).parquet(f"{self.root}/{table}/version={run}").filter(F.col(OP).isNotNull())
        key = F.to_json(F.struct(*keys)).alias("key")
        return rows.select(
            F.lit(table).alias("table_name"), "symbol", key, F.col(OP).alias("op"), F.col(CHANGED).alias("changed_columns"), "bucket", "year"
        )

    def write_changes(self, rows: DataFrame, run: str) -> DataFrame:
        """Write the change log of a run; the commit that names it makes it visible."""
        return self._written(f"{self.root}/_changes/run={run}", rows)

    def read_changes(self, after: int = 0, upto: int | None = None) -> DataFrame:
        """The change logs of a range of commits, with the columns commit and run."""
        named = [(h["commit"], h["changes"]) for h in self.heads(after, upto) if h["changes"]]
        if not named:
            return self.spark.createDataFrame([], f"commit int, run string, {CHANGE_SCHEMA}")
        folder = f"{self.root}/_changes"
        reader = self.spark.read.schema(f"{CHANGE_SCHEMA}, run string").option("basePath", folder)
        rows = reader.parquet(*[f"{folder}/run={run}" for _, run in named])
        return rows.join(self.spark.createDataFrame(named, "commit int, run string"), "run")

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the cells that none of the last ``keep`` commits reads, older commits but for
        their heads, and what runs left that never committed.  The change log stays.

        For a store that no run is writing to; returns the deleted folders.
        """
        self.head()  # refuses a store without a readable commit
        readable = [(n, c) for n in self._numbers("_commits") if (c := self.commit_at(n)) is not None]
        kept = {(t, v, cell) for _, c in readable[-keep:] for t, cells in c.layout.items() for cell, v in cells.items()}
        versions = {(t, v) for t, v, _ in kept}
        gone = []
        for table in schemas.TABLES:
            for name in self._names(table):
                version = name.removeprefix("version=")
                if not name.startswith("version="):
                    continue
                if (table, version) not in versions:
                    self._delete(f"{table}/{name}")
                    gone.append(f"{table}/{name}")
                    continue
                for bucket in self._names(f"{table}/{name}"):
                    for year in self._names(f"{table}/{name}/{bucket}") if bucket.startswith("bucket=") else []:
                        cell = int(bucket.removeprefix("bucket=")), int(year.removeprefix("year="))
                        if (table, version, cell) not in kept:
                            self._delete(f"{table}/{name}/{bucket}/{year}")
                            gone.append(f"{table}/{name}/{bucket}/{year}")
        for n, c in readable[:-keep]:
            file = f"_commits/{n:010d}"
            try:
                self._publish(f"{file}.head", {"commit": n, "run": c.run, "changes": c.changes, "streams": c.streams})
            except CommitConflict:  # an earlier vacuum came this far
                pass
            self._delete(f"{file}.json")
        heads = self.heads()
        named = {h["changes"] for h in heads} | {h["run"].split(ATTEMPT)[0] for h in heads}
        for folder in ("_runs", "_changes", "_staging"):
            for name in self._names(folder):
                if folder == "_staging" or name.removeprefix("run=") not in named:
                    self._delete(f"{folder}/{name}")
                    gone.append(f"{folder}/{name}")
        for name in self._names("_commits"):
            if name.endswith(".tmp"):
                self._delete(f"_commits/{name}")
        return gone
