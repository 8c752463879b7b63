"""Keys, upsert, store, ingest runs and the stream."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import ingest, keys, upsert
from ledgerlens.sources.store import CommitConflict, VersionedStore
from ledgerlens.streaming.upsert_stream import stream_upsert, stream_upsert_all
from tests.conftest import rows

KEYS = ["symbol", "calendaryear", "period"]
SCHEMA = "symbol string, calendaryear int, period string, revenue long, eps double"


@pytest.fixture
def stored(spark):
    return spark.createDataFrame(
        [
            ("A", 2020, "Q1", 10, 1.23452),
            ("A", 2020, "Q2", 20, None),
            ("B", 2020, "Q1", 30, 1.2345),
            ("C", 2020, "Q1", 40, 2.0),
        ],
        SCHEMA,
    )


@pytest.fixture
def batch(spark):
    return spark.createDataFrame(
        [
            ("A", 2020, "Q1", 10, 1.23451),
            ("A", 2020, "Q2", None, 3.0),
            ("B", 2020, "Q1", 31, 1.2347),
            ("D", 2021, "Q4", 50, None),
        ],
        SCHEMA,
    )


def test_classify(batch, stored):
    got = {(r.symbol, r.period): r.op for r in upsert.classify(batch, stored, KEYS).collect()}
    assert got == {
        ("A", "Q1"): "same", ("A", "Q2"): "update", ("B", "Q1"): "update", ("D", "Q4"): "insert",
    }


def test_inserts(batch, stored):
    assert rows(upsert.inserts(batch, stored, KEYS)) == [("D", 2021, "Q4", 50, None)]


def test_update_set(batch, stored):
    assert rows(upsert.update_set(batch, stored, KEYS)) == [
        ("A", 2020, "Q2", None, 3.0, ["eps"]),
        ("B", 2020, "Q1", 31, 1.2347, ["revenue", "eps"]),
    ]


MERGED = [
    ("A", 2020, "Q1", 10, 1.23452),
    ("A", 2020, "Q2", 20, 3.0),
    ("B", 2020, "Q1", 31, 1.2347),
    ("C", 2020, "Q1", 40, 2.0),
    ("D", 2021, "Q4", 50, None),
]


def test_apply_is_idempotent(batch, stored):
    once = upsert.apply_batch(batch, stored, KEYS)
    assert rows(once) == MERGED
    assert rows(upsert.apply_batch(batch, once, KEYS)) == MERGED
    assert upsert.change_log(batch, once, KEYS, "t").count() == 0


def test_apply_keeps_columns_the_batch_lacks(batch, stored):
    got = upsert.apply_batch(batch.drop("eps"), stored, KEYS)
    assert rows(got)[2] == ("B", 2020, "Q1", 31, 1.2345)
    assert rows(got)[4] == ("D", 2021, "Q4", 50, None)


def test_change_log(batch, stored):
    got = rows(upsert.change_log(batch, stored, KEYS, "t"))
    assert got == [
        ("t", "A", 2020, "Q2", "update", ["eps"]),
        ("t", "B", 2020, "Q1", "update", ["revenue", "eps"]),
        ("t", "D", 2021, "Q4", "insert", None),
    ]


def test_dedup_batch(batch):
    assert rows(upsert.dedup_batch(batch.unionByName(batch), KEYS)) == rows(batch)


def test_update_by_symbol(spark, stored):
    new = spark.createDataFrame([("A", "99"), ("Z", "1")], "symbol string, value string")
    got = upsert.update_by_symbol(stored, "revenue", new)
    assert [(r[0], r[3], r[5]) for r in rows(got)] == [
        ("A", 99, True), ("A", 99, True), ("B", 30, False), ("C", 40, False),
    ]


def test_surrogate_ids_are_dense_and_stable(spark):
    df = spark.range(500).selectExpr("concat('S', id) AS symbol")
    start = spark.createDataFrame([(100,)], "max_id long")
    first = {r.symbol: r.id for r in keys.surrogate_ids(df, "symbol", start).collect()}
    again = {
        r.symbol: r.id for r in keys.surrogate_ids(df.repartition(3), "symbol", start).collect()
    }
    assert first == again
    assert sorted(first.values()) == list(range(101, 601))
    empty = spark.createDataFrame([(None,)], "max_id long")
    from_one = keys.surrogate_ids(df, "symbol", empty).agg({"id": "min"}).first()[0]
    assert from_one == 1


def test_fk_resolve_adds_one_stub(spark):
    company = spark.createDataFrame([(7, "A", "Alpha")], "id long, symbol string, companyname string")
    facts = spark.createDataFrame([("A", 1), ("N", 2), ("N", 3)], "symbol string, v int")
    extended = keys.with_stubs(facts, company)
    assert rows(extended) == [(7, "A", "Alpha"), (8, "N", None)]
    assert rows(keys.fk_resolve(facts, extended)) == [(7, "A", 1), (8, "N", 2), (8, "N", 3)]
    with pytest.raises(ValueError):
        keys.fk_resolve(facts.withColumnRenamed("v", "company_id"), company)
    with pytest.raises(ValueError):
        keys.fk_resolve(facts.select("v"), company)


INCOME = "symbol string, date string, calendarYear string, period string, revenue string"


def income(spark, *data):
    return spark.createDataFrame(list(data), INCOME)


def test_ingest_run(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path / "store"), buckets=4)
    first = income(
        spark,
        ("A", "2020-03-31", "2020", "Q1", "10"),
        ("B", "2020-03-31", "2020", "Q1", "20"),
    )
    status = ingest.ingest(store, {"income_statement_quarter": first})
    assert rows(status) == [("A", True), ("B", True)]

    profile = spark.createDataFrame([("A", "Alpha"), ("B", "Beta")], "symbol string, companyName string")
    second = income(
        spark,
        ("A", "2020-03-31", "2020", "Q1", "11"),
        ("A", "2020-06-30", "2020", "Q2", "12"),
        ("B", "2020-06-30", "n/a", "Q2", "99"),
        ("B", "2020-03-31", "2020", "Q1", "21"),
    )
    status = ingest.ingest(store, {"company": profile, "income_statement_quarter": second})
    assert rows(status) == [("A", True), ("B", False)]
    assert rows(ingest.status_counts(status)) == [(1, 1)]
    # B failed in one dataset and is left as it was in both tables
    table = store.read("income_statement_quarter")
    assert [(r.symbol, r.period, r.revenue) for r in table.orderBy("symbol", "period").collect()] == [
        ("A", "Q1", 11), ("A", "Q2", 12), ("B", "Q1", 20),
    ]
    names = {r.symbol: (r.id, r.companyname) for r in store.read("company").collect()}
    assert sorted(i for i, _ in names.values()) == [1, 2]
    assert names["A"][1] == "Alpha" and names["B"][1] is None
    assert {r.symbol: r.company_id for r in table.collect()} == {s: i for s, (i, _) in names.items()}
    assert store.read_symbol("income_statement_quarter", "A").count() == 2


def test_failed_run_is_invisible(spark, tmp_path, monkeypatch):
    store = VersionedStore(spark, str(tmp_path / "store"), buckets=2)
    ingest.ingest(store, {"income_statement_fy": income(spark, ("A", "2020-12-31", "2020", "FY", "1"))})

    def fail(*_):
        raise OSError("lost before commit")

    monkeypatch.setattr(VersionedStore, "commit", fail)
    later = income(spark, ("A", "2020-12-31", "2020", "FY", "2"))
    with pytest.raises(OSError):
        ingest.ingest(store, {"income_statement_fy": later})
    assert [r.revenue for r in store.read("income_statement_fy").collect()] == [1]
    monkeypatch.undo()
    ingest.ingest(store, {"income_statement_fy": later})
    assert [r.revenue for r in store.read("income_statement_fy").collect()] == [2]


def test_csv_bootstrap(spark, tmp_path):
    for folder in ingest.CSV_FOLDERS:
        for symbol in ("A", "B"):
            path = tmp_path / folder / symbol
            path.mkdir(parents=True)
            (path / "data.csv").write_text(
                "date,symbol,calendarYear,period,extra\n"
                f"2020-12-31,{symbol},2020,FY,x\n2021-12-31,{symbol},2021,FY,x\n"
            )
    store = VersionedStore(spark, str(tmp_path / "store"), buckets=2)
    status = ingest.csv_bootstrap(store, str(tmp_path))
    assert rows(status) == [("A", True), ("B", True)]
    for table in ingest.CSV_FOLDERS.values():
        assert store.read(table).count() == 4
    assert store.read("company").count() == 2
    years = store.read("balance_sheet_fy").filter("symbol = 'A'").select("date")
    assert [r[0] for r in rows(years)] == [datetime.date(2020, 12, 31), datetime.date(2021, 12, 31)]


def test_stream_upserts_each_file_once(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path / "store"), buckets=2)
    landing = tmp_path / "landing"
    landing.mkdir()

    def land(name, *records):
        (landing / name).write_text(json.dumps(list(records)) + "\n")

    def run():
        stream_upsert(store, str(landing), "price", str(tmp_path / "checkpoint"))
        found = store.read("price").select("symbol", "date", "close", "volume").collect()
        return sorted((r.symbol, str(r.date), r.close, r.volume) for r in found)

    land("a.json", {"symbol": "A", "date": "2020-01-02", "close": 1.5, "volume": 10})
    assert run() == [("A", "2020-01-02", 1.5, 10)]
    # a late correction of one field and a new row
    land(
        "b.json",
        {"symbol": "A", "date": "2020-01-02", "close": 1.6},
        {"symbol": "A", "date": "2019-12-31", "close": 1.0, "volume": 5},
    )
    assert run() == [("A", "2019-12-31", 1.0, 5), ("A", "2020-01-02", 1.6, 10)]
    commits, _ = store.current()
    assert run() == [("A", "2019-12-31", 1.0, 5), ("A", "2020-01-02", 1.6, 10)]
    assert store.current()[0] == commits


RESTATED = [("500", None), ("100", "7"), ("900", None)]


@pytest.mark.parametrize("files_per_batch", [1, None])
def test_stream_result_does_not_depend_on_files_per_batch(spark, tmp_path, files_per_batch):
    store = VersionedStore(spark, str(tmp_path / "store"), buckets=2)
    landing = tmp_path / "landing"
    landing.mkdir()
    for k, (revenue, net) in enumerate(RESTATED):
        record = {"symbol": "A", "date": "2020-03-31", "calendarYear": "2020.0", "period": "Q1", "revenue": revenue + ".0", "netIncome": net}
        path = landing / f"{k}.json"
        path.write_text(json.dumps(record) + "\n")
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    stream_upsert(store, str(landing), "income_statement_quarter", str(tmp_path / "checkpoint"), files_per_batch)
    found = store.read("income_statement_quarter").select("symbol", "calendaryear", "revenue", "netincome")
    assert rows(found) == [("A", 2020, 900, 7)]


def test_latest_cells(spark):
    batch = spark.createDataFrame(
        [("A", 2020, "2021-02-01", 100, None), ("A", 2020, "2021-01-01", 90, 5), ("A", 2020, None, 80, 4), ("B", 2020, None, None, None)],
        "symbol string, calendaryear int, fillingdate string, revenue int, netincome int",
    )
    got = upsert.latest_cells(batch.unionByName(batch).repartition(3), ["symbol", "calendaryear"])
    assert rows(got) == [("A", 2020, "2021-02-01", 100, 5), ("B", 2020, None, None, None)]
    only_keys = batch.select("symbol", "calendaryear")
    assert rows(upsert.latest_cells(only_keys, ["symbol", "calendaryear"])) == [("A", 2020), ("B", 2020)]


def test_two_runs_at_once(spark, tmp_path, monkeypatch):
    """A run that finds another's commit keeps both, also where both wrote one bucket."""
    table = "income_statement_fy"
    store = VersionedStore(spark, str(tmp_path / "store"), buckets=1)
    ingest.ingest(store, {table: income(spark, ("A", "2019-12-31", "2019", "FY", "1"))})
    commit, entered = VersionedStore.commit, []

    def interrupted(self, *args):
        if not entered:
            entered.append(1)
            other = VersionedStore(spark, str(tmp_path / "store"), buckets=1)
            ingest.ingest(other, {table: income(spark, ("B", "2020-12-31", "2020", "FY", "2"))})
        return commit(self, *args)

    monkeypatch.setattr(VersionedStore, "commit", interrupted)
    ingest.ingest(store, {table: income(spark, ("C", "2020-12-31", "2020", "FY", "3"))})
    found = store.read(table).select("symbol", "revenue", "company_id")
    assert sorted((s, r) for s, r, _ in rows(found)) == [("A", 1), ("B", 2), ("C", 3)]
    assert sorted(r.id for r in store.read("company").collect()) == [1, 2, 3]
    assert store.current()[0] == 3
    assert not list((tmp_path / "store" / "_staging").glob("run=*"))
    assert len(store.vacuum(keep=1)) >= 2
    assert rows(store.read(table).select("symbol", "revenue", "company_id")) == rows(found)


def test_commit_number_is_taken_once(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path / "store"), buckets=1)
    base = store.head()
    store.commit(base, {"price": [(0, 2020)]}, "first")
    with pytest.raises(CommitConflict):
        store.commit(base, {"price": [(0, 2020)]}, "second")
    assert store.current() == (1, {"price": {(0, 2020): "first"}})
    assert [f.name for f in (tmp_path / "store" / "_commits").iterdir()] == ["0000000001.json"]


def test_shares_and_change_log_of_a_run(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path / "store"), buckets=2)
    batch = income(spark, ("A", "2020-12-31", "2020", "FY", "5")).withColumn("weightedAverageShsOutDil", F.lit("1.5E3"))
    ingest.ingest(store, {"income_statement_fy": batch})
    assert rows(store.read("shares_fy").select("symbol", "date", "numberofshares")) == [("A", datetime.date(2020, 12, 31), 1500)]
    later = batch.withColumn("revenue", F.lit("6"))
    ingest.ingest(store, {"income_statement_fy": later})
    log = ingest.change_log(store).select("table_name", "symbol", "op", F.concat_ws(",", "changed_columns").alias("c"))
    assert rows(log.filter("op = 'update'")) == [("income_statement_fy", "A", "update", "revenue")]
    assert {r[0] for r in rows(log.filter("op = 'insert'"))} == {"company", "income_statement_fy", "shares_fy"}


def test_one_stream_for_all_tables(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path / "store"), buckets=2)
    landing = tmp_path / "landing"

    def land(table, name, *records):
        (landing / table).mkdir(parents=True, exist_ok=True)
        (landing / table / name).write_text("\n".join(map(json.dumps, records)) + "\n")

    price = {"symbol": "A", "date": "2020-01-02", "close": 1.5, "volume": "10.0"}
    quarter = {"symbol": "B", "date": "2020-03-31", "calendarYear": "2020", "period": "Q1", "revenue": 5}
    land("price", "a.json", [price, {**price, "date": "2020-01-03"}], price)
    land("income_statement_quarter", "a.json", quarter)
    land("other", "a.json", {"symbol": "C"})
    stream_upsert_all(store, str(landing), str(tmp_path / "checkpoint"))
    assert rows(store.read("price").select("symbol", "date", "volume")) == [
        ("A", datetime.date(2020, 1, 2), 10),
        ("A", datetime.date(2020, 1, 3), 10),
    ]
    assert rows(store.read("income_statement_quarter").select("symbol", "revenue")) == [("B", 5)]
    assert {r.symbol for r in store.read("company").collect()} == {"A", "B"}
    assert store.current()[0] == 1
    land("price", "b.json", {"symbol": "A", "date": "2020-01-02", "close": 1.6})
    stream_upsert_all(store, str(landing), str(tmp_path / "checkpoint"))
    assert store.current()[0] == 2
    assert store.read("price").filter("close = 1.6 AND volume = 10").count() == 1


def test_places_of_cells_are_ranks_of_files(spark):
    """The order is that of time and name; what is grouped carries a number and no path."""
    late, early = datetime.datetime(2024, 1, 2), datetime.datetime(2024, 1, 1)
    batch = spark.createDataFrame(
        [("A", 1, None, late, "a"), ("A", 2, 7, early, "z"), ("A", 3, 8, early, "b"), ("B", None, 1, None, None), ("B", 5, None, early, None)],
        "symbol string, revenue int, netincome int, at timestamp, file string",
    )
    got = upsert.latest_cells(batch.repartition(3), ["symbol"], ["at", "file"])
    assert rows(got) == [("A", 1, 7), ("B", 5, 1)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "file" not in next(line for line in plan.splitlines() if "max_by" in line)


def test_stream_drops_columns_no_file_has(spark, tmp_path, monkeypatch):
    """Files are read once, and declared columns that none of them fills are not compared."""
    seen, latest = {}, upsert.latest_cells
    monkeypatch.setattr(upsert, "latest_cells", lambda b, *a: seen.setdefault(len(seen), b.columns) and latest(b, *a))
    landing = tmp_path / "landing"
    for table, record in (("income_statement_fy", {"revenue": 5}), ("balance_sheet_fy", {"totalAssets": 6}), ("other", {"x": 1})):
        (landing / table).mkdir(parents=True)
        lines = [json.dumps({"symbol": s, "date": "2020-12-31", "calendarYear": "2020", "period": "FY", **record}) for s in "AB"]
        (landing / table / "1.json").write_text("\n".join(lines) + "\n")
    store = VersionedStore(spark, str(tmp_path / "store"), buckets=2)
    stream_upsert_all(store, str(landing), str(tmp_path / "checkpoint"))
    assert rows(store.read("income_statement_fy").select("symbol", "revenue")) == [("A", 5), ("B", 5)]
    assert rows(store.read("balance_sheet_fy").select("symbol", "totalassets")) == [("A", 6), ("B", 6)]
    assert rows(store.read("shares_fy").select("symbol", "numberofshares")) == [("A", None), ("B", None)]
    assert max(len(c) for c in seen.values()) <= 8 and any("revenue" in c for c in seen.values())
    assert not list((tmp_path / "store" / "_staging").glob("run=*"))
