"""Ingest runs: normalise, resolve companies, upsert every table, commit once."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens.operators import keys, upsert
from ledgerlens.operators.normalize import normalize
from ledgerlens.operators.statements import shares_from_income
from ledgerlens.sources.readers import read_csv_tree, seed_companies
from ledgerlens.sources.store import ATTEMPT, CHANGED, OP, Cell, CommitConflict, Layout, VersionedStore


def _dataset_of(table: str) -> str:
    for dataset, (stem, periodic) in schemas.DATASETS.items():
        names = [f"{stem}_{p}" for p in schemas.PERIODS] if periodic else [stem]
        if table in names:
            return dataset
    raise ValueError(f"no dataset loads table {table!r}")


def keys_of(table: str, columns: Iterable[str] | None = None) -> list[str]:
    """Merge keys of a table for a batch with the given columns (default: all declared)."""
    have = schemas.compared_columns(table) if columns is None else columns
    return schemas.merge_keys(_dataset_of(table), have)


def ingest_status(batches: Mapping[str, DataFrame]) -> DataFrame:
    """(symbol, ok) over all batches: a symbol fails if any of its rows lacks a key."""
    checked = []
    for table, batch in batches.items():
        by = keys_of(table, batch.columns)
        lacking = [k for k in by if k not in batch.columns]
        if lacking:
            raise ValueError(f"batch for {table} has no column {', '.join(lacking)}")
        valid = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in by])
        checked.append(batch.select("symbol", valid.alias("ok")))
    rows = reduce(DataFrame.unionByName, checked)
    return rows.groupBy("symbol").agg(F.bool_and("ok").alias("ok"))


def status_counts(status: DataFrame) -> DataFrame:
    return status.agg(
        F.count_if("ok").alias("successful"), F.count_if(~F.col("ok")).alias("failed")
    )


#: columns that place a row in a cell, or a share count
PLACED = ("symbol", "date", "calendaryear", "period", "weightedaverageshsoutdil")
#: attempts of a run whose commits collide with those of other runs
ATTEMPTS = 10


def ingest(
    store: VersionedStore, raw: Mapping[str, DataFrame], log: bool = True, source: tuple[str, int] | None = None
) -> DataFrame:
    """Upsert provider batches (stored table name to rows) in one commit.

    A symbol with an invalid row in any batch is left out of all tables.  Fiscal-year income
    also fills ``shares_fy``.  Returns the status per symbol; with ``log`` the changes of the run
    are published by its commit, for ``change_log``.  Cells in which nothing changed are not
    committed, and running the same batches again commits nothing.

    ``source`` names a stream and the number of its batch; the commit keeps the number, and a
    batch that the store has already taken is left out.

    Several runs may work on one store.  Whoever commits second reads the layout again: if the
    other run left its cells alone, the same files are committed on top of it; else the run merges
    anew with what is stored now.  Ids of new companies come from a range that a run reserves, so
    runs that bring different companies do not meet.
    """
    run = store.new_run()
    batches = {
        table: store.stage(table, normalize(df, table, False, schemas.LANDING), run)
        for table, df in raw.items()
    }
    if source is not None and batches:
        # A stream reads every declared column, whatever its files hold.
        needed = {t: {*keys_of(t, b.columns), *schemas.LANDING, *PLACED} for t, b in batches.items()}
        batches = upsert.filled_columns(batches, needed)
    status = store.record("status", ingest_status(batches), run)
    failed = status.filter(~F.col("ok")).select("symbol")
    good = {t: b.filter(F.col("symbol").isNotNull()).join(failed, "symbol", "left_anti") for t, b in batches.items()}
    reserved = _Reserved(store)
    base, written, version = store.head(), None, f"{run}{ATTEMPT}0"
    for attempt in range(1, ATTEMPTS + 1):
        if source is not None and base.streams.get(source[0], -1) >= source[1]:
            break
        if written is None:
            version = f"{run}{ATTEMPT}{attempt}"
            written = _merge(store, good, base.layout, version, log, reserved)
        if not written:
            break
        try:
            store.commit(base, written, version, dict([source] if source else []), version if log else None)
            break
        except CommitConflict:
            now = store.head()
            if _meet(base.layout, now.layout, written):
                store.drop_staging(version)
                written = None
            base = now
    else:
        raise CommitConflict(f"gave up after {ATTEMPTS} attempts")
    store.drop_staging(run)
    store.drop_staging(version)
    return status


def _meet(before: Layout, now: Layout, written: Mapping[str, Iterable[Cell]]) -> bool:
    """Whether another run changed a written cell.  A company that both brought is in such a cell."""
    return any(before.get(t, {}).get(c) != now.get(t, {}).get(c) for t, cells in written.items() for c in cells)


class _Reserved:
    """The range of company ids of a run; it serves all attempts that need no more of them."""

    def __init__(self, store: VersionedStore):
        self.store, self.first, self.size = store, 1, 0

    def take(self, count: int) -> int:
        if count > self.size:
            self.first, self.size = self.store.reserve_ids(count), count
        return self.first


def _company_ids(
    store: VersionedStore, symbols: DataFrame, layout: Layout, version: str, reserved: _Reserved
) -> tuple[DataFrame, DataFrame]:
    """(id, symbol) of the run's companies, and of those among them that are new."""
    buckets = sorted({r.bucket for r in symbols.select(store.bucket_of().alias("bucket")).distinct().collect()})
    stored = store.read("company", buckets, layout).select("id", "symbol")
    missing = store.stage("missing", symbols.join(stored, "symbol", "left_anti"), version)
    count = missing.count()
    if count:
        start = store.spark.range(1).select(F.lit(reserved.take(count) - 1).cast("long").alias("max_id"))
        new = store.stage("new_ids", keys.surrogate_ids(missing, "symbol", start).select("id", "symbol"), version)
    else:
        new = stored.limit(0)
    known = stored.join(symbols, "symbol", "left_semi")
    return known.unionByName(new), new


def _merge(
    store: VersionedStore, batches: Mapping[str, DataFrame], layout: Layout, version: str, log: bool, reserved: _Reserved
) -> dict[str, list[Cell]]:
    """Write the touched cells of all tables, and the change log, as ``version``; returns the cells
    in which something changed."""
    # Distinct symbols combine before the shuffle, so one that landed very many times does not
    # meet in one task.
    every = reduce(DataFrame.unionByName, [b.select("symbol") for b in batches.values()]).distinct()
    symbols = store.stage("symbols", every, version)
    ids, new = _company_ids(store, symbols, layout, version, reserved)
    prepared, by, touching = {}, {}, {}
    for table, batch in batches.items():
        landing = [c for c in schemas.LANDING if c in batch.columns]
        by[table], touching[table] = keys_of(table, batch.columns), batch
        rows = upsert.latest_cells(batch, by[table], landing)
        if table == "company":
            own = rows.select("symbol").unionByName(new.select("symbol")).distinct()
            prepared[table] = ids.join(own, "symbol", "left_semi").join(rows, "symbol", "left")
            touching[table] = batch.select("symbol").unionByName(new.select("symbol"))
        else:
            prepared[table] = keys.fk_resolve(rows, ids)
    if "company" not in batches:
        by["company"], prepared["company"], touching["company"] = keys_of("company"), new, new
    income = batches.get("income_statement_fy")
    if income is not None and {"date", "weightedaverageshsoutdil"} <= set(income.columns):
        dated = prepared["income_statement_fy"].filter("date IS NOT NULL")
        by["shares_fy"] = ["symbol", "date"]
        prepared["shares_fy"] = upsert.latest_cells(shares_from_income(dated), by["shares_fy"])
        touching["shares_fy"] = income.filter("date IS NOT NULL").select("symbol", "date")

    touched = store.touched(touching)
    changes = []
    for table, cells in touched.items():
        stored = store.read(table, layout=layout, cells=cells)
        merged = upsert.apply_and_tell(prepared[table], stored, by[table], OP, CHANGED)
        store.write_version(table, merged, version, len(cells))
        changes.append(store.changes_of(table, version, by[table]))
    if not changes:
        return {}
    rows = reduce(DataFrame.unionByName, changes)
    if log:
        rows = store.write_changes(rows, version)
    changed: dict[str, list[Cell]] = {}
    for r in rows.select("table_name", "bucket", "year").distinct().collect():
        changed.setdefault(r.table_name, []).append((r.bucket, r.year))
    return {t: sorted(cells) for t, cells in changed.items()}


def change_log(store: VersionedStore, after: int = 0, upto: int | None = None) -> DataFrame:
    """Inserted and updated keys of the commits above ``after`` up to ``upto``: commit, run,
    table_name, symbol, key (JSON), op and changed_columns.  Runs that never committed are not
    listed; a store without commits gives no rows."""
    return store.read_changes(after, upto).select("commit", "run", "table_name", "symbol", "key", "op", "changed_columns")


# Folders of the local statement files and the tables they fill.
CSV_FOLDERS = {
    "income_statements": "income_statement_fy",
    "balance_sheets": "balance_sheet_fy",
    "cash_flows": "cash_flow_statement_fy",
}


def csv_bootstrap(store: VersionedStore, folder: str) -> DataFrame:
    """Load the three statement folders into the fiscal-year tables.

    Companies are seeded from the balance sheets; a symbol only other folders know
    gets its stub in the same run.
    """
    read = {t: read_csv_tree(store.spark, f"{folder}/{f}") for f, t in CSV_FOLDERS.items()}
    seeds = seed_companies(read["balance_sheet_fy"])
    return ingest(store, {"company": seeds, **read})
