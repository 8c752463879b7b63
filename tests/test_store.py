"""Commits, cells, change feed, id ranges and replays of the versioned store."""

import datetime
import json
import re
import threading
import warnings

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import ingest
from ledgerlens.plans import reports
from ledgerlens.sources.store import CommitConflict, StoreDamaged, VersionedStore
from ledgerlens.streaming import upsert_stream
from tests.conftest import rows


@pytest.fixture
def store(spark, tmp_path):
    return VersionedStore(spark, str(tmp_path / "store"), buckets=2)


def prices(spark, *data):
    return spark.createDataFrame([(s, d, str(c)) for s, d, c in data], "symbol string, date string, close string")


def closes(store, **of):
    found = store.read("price", **of).select("symbol", "date", "close").collect()
    return sorted((r.symbol, str(r.date), r.close) for r in found)


def files(store, pattern):
    from pathlib import Path

    return sorted(str(p.relative_to(store.root)) for p in Path(store.root).glob(pattern))


def newest(store):
    from pathlib import Path

    return max(Path(store.root, "_commits").glob("*.json"))


DAMAGES = {
    "empty": lambda text: b"",
    "half a head": lambda text: text[:20],
    "without its last line": lambda text: text[: text[:-1].rindex(b"\n") + 1],
    "half a line": lambda text: text[:-9],
    "one letter": lambda text: text.replace(b'"price"', b'"prize"', 1),
    "another format": lambda text: text.replace(b'"format": 2', b'"format": 1', 1),
    "no JSON": lambda text: b"\xff\x00{",
}


@pytest.mark.parametrize("damage", DAMAGES)
def test_damaged_newest_commit_loses_nothing(spark, store, damage):
    ingest.ingest(store, {"price": prices(spark, ("AAA", "2020-01-02", 1.0))})
    good = newest(store).read_bytes()
    torn = newest(store).parent / "0000000002.json"
    torn.write_bytes(DAMAGES[damage](good))
    with pytest.warns(UserWarning, match="commits 2 .* commit 1 counts"):
        assert closes(store) == [("AAA", "2020-01-02", 1.0)]
    with pytest.warns(UserWarning):
        ingest.ingest(store, {"price": prices(spark, ("BBB", "2020-01-02", 2.0))})
    with warnings.catch_warnings():
        warnings.simplefilter("error")  # the damaged commit is behind the newest now
        assert closes(store) == [("AAA", "2020-01-02", 1.0), ("BBB", "2020-01-02", 2.0)]
    assert store.current()[0] == 3
    assert sorted(r.id for r in store.read("company").collect()) == [1, 2]
    assert torn.read_bytes() == DAMAGES[damage](good)


def test_store_without_a_readable_commit_is_refused(spark, store):
    ingest.ingest(store, {"price": prices(spark, ("AAA", "2020-01-02", 1.0))})
    newest(store).write_bytes(b"")
    for attempt in (lambda: store.read("price"), store.vacuum, lambda: ingest.ingest(store, {"price": prices(spark, ("B", "2020-01-02", 1.0))})):
        with pytest.raises(StoreDamaged):
            attempt()


def test_writer_that_dies_while_it_writes_a_commit(spark, store, monkeypatch):
    """What it leaves has a hidden name, so neither readers nor numbers see it."""
    ingest.ingest(store, {"price": prices(spark, ("AAA", "2020-01-02", 1.0))})

    def die(*_):
        raise OSError("died before the rename")

    monkeypatch.setattr(VersionedStore, "_rename", die)
    with pytest.raises(OSError):
        ingest.ingest(store, {"price": prices(spark, ("AAA", "2020-01-02", 9.0))})
    monkeypatch.undo()
    (newest(store).parent / ".left.tmp").write_bytes(b"{")
    assert closes(store) == [("AAA", "2020-01-02", 1.0)]
    ingest.ingest(store, {"price": prices(spark, ("AAA", "2020-01-02", 3.0))})
    assert closes(store) == [("AAA", "2020-01-02", 3.0)] and store.current()[0] == 2
    gone = store.vacuum(keep=1)
    assert gone and not files(store, "_commits/.*.tmp")
    assert closes(store) == [("AAA", "2020-01-02", 3.0)]


def test_one_of_many_writers_gets_a_number(spark, store):
    base, won, lost = store.head(), [], []

    def write(name):
        try:
            store.commit(base, {"price": [(0, 2020)]}, name)
            won.append(name)
        except CommitConflict:
            lost.append(name)

    threads = [threading.Thread(target=write, args=(f"run{k}",)) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and len(lost) == 7
    assert store.current() == (1, {"price": {(0, 2020): won[0]}})


def test_ids_are_reserved_once(spark, store):
    first = []
    threads = [threading.Thread(target=lambda: first.append(store.reserve_ids(10))) for _ in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(first) == [1, 11, 21, 31, 41, 51]


def test_one_day_rewrites_the_cells_of_its_year(spark, store, monkeypatch):
    history = [(s, f"{y}-06-{d:02d}", y + d / 10) for s in ("A", "B", "C", "D") for y in (2018, 2019, 2020) for d in (1, 2)]
    ingest.ingest(store, {"price": prices(spark, *history)})
    _, before = store.current()
    read, seen = VersionedStore.read, []

    def watched(self, table, *args, **of):
        df = read(self, table, *args, **of)
        if table == "price":
            seen.extend(df.inputFiles())
        return df

    monkeypatch.setattr(VersionedStore, "read", watched)
    ingest.ingest(store, {"price": prices(spark, *[(s, "2020-06-03", 7.0) for s in ("A", "B", "C", "D")])})
    monkeypatch.undo()
    _, after = store.current()
    # The stored side of the join lists files of the batch's year only, and only these are new.
    assert seen and all("/year=2020/" in f for f in seen)
    new = {c: v for c, v in after["price"].items() if before["price"][c] != v}
    assert {y for _, y in new} == {2020}
    assert all("/year=2020/" in f for v in set(new.values()) for f in files(store, f"price/version={v}/**/*.parquet"))
    assert after["company"] == before["company"]  # known companies are left alone
    assert len(closes(store)) == 4 * 7
    assert closes(store, years=[2019]) == sorted((s, d, c) for s, d, c in history if d[:4] == "2019")
    assert store.read_symbol("price", "A", years=[2020]).count() == 3


def test_restated_statement_stays_in_its_cell(spark, store):
    schema = "symbol string, date string, calendarYear string, period string, revenue string"
    one = spark.createDataFrame([("A", "2020-12-31", "2020", "Q4", "5")], schema)
    later = spark.createDataFrame([("A", "2021-01-02", "2020", "Q4", "6")], schema)
    for batch in (one, later):
        ingest.ingest(store, {"income_statement_quarter": batch})
    found = store.read("income_statement_quarter").select("symbol", "date", "revenue")
    assert rows(found) == [("A", datetime.date(2021, 1, 2), 6)]
    assert {y for _, y in store.current()[1]["income_statement_quarter"]} == {2020}


def test_same_batch_again_commits_nothing(spark, store):
    batch = prices(spark, ("A", "2020-01-02", 1.0), ("B", "2021-01-02", 2.0))
    ingest.ingest(store, {"price": batch})
    ingest.ingest(store, {"price": batch})
    assert store.current()[0] == 1
    changed = prices(spark, ("A", "2020-01-02", 1.0), ("B", "2021-01-02", 3.0))
    ingest.ingest(store, {"price": changed})
    number, layout = store.current()
    assert number == 2
    # Only the cell with a change has a new version.
    assert sorted(y for (_, y), v in layout["price"].items() if v == max(layout["price"].values())) == [2021]


def test_change_feed_by_range_of_commits(spark, store):
    assert ingest.change_log(store).collect() == []
    ingest.ingest(store, {"price": prices(spark, ("A", "2020-01-02", 1.0), ("A", "2020-01-03", 1.5))})
    ingest.ingest(store, {"price": prices(spark, ("A", "2020-01-03", 2.0), ("B", "2020-01-03", 9.0))})
    ingest.ingest(store, {"price": prices(spark, ("B", "2021-01-03", 9.0))}, log=False)
    feed = lambda *of: rows(ingest.change_log(store, *of).filter("table_name = 'price'").select("commit", "symbol", "key", "op", F.concat_ws(",", "changed_columns").alias("c")))
    key = lambda s, d: json.dumps({"symbol": s, "date": d}, separators=(",", ":"))
    first = [(1, "A", key("A", "2020-01-02"), "insert", ""), (1, "A", key("A", "2020-01-03"), "insert", "")]
    second = [(2, "A", key("A", "2020-01-03"), "update", "close"), (2, "B", key("B", "2020-01-03"), "insert", "")]
    assert feed() == first + second
    assert feed(1) == second and feed(0, 1) == first and feed(2) == []
    # The feed outlives the versions it tells of.
    store.vacuum(keep=1)
    assert feed() == first + second
    assert len(closes(store)) == 4


def test_change_log_of_a_run_that_never_commits(spark, store, monkeypatch):
    ingest.ingest(store, {"price": prices(spark, ("A", "2020-01-02", 1.0))})

    def fail(*_):
        raise OSError("lost before commit")

    monkeypatch.setattr(VersionedStore, "commit", fail)
    with pytest.raises(OSError):
        ingest.ingest(store, {"price": prices(spark, ("A", "2020-01-02", 2.0))})
    monkeypatch.undo()
    assert {r.commit for r in ingest.change_log(store).collect()} == {1}
    assert len(files(store, "_runs/run=*")) == 2
    store.vacuum(keep=1)
    assert len(files(store, "_runs/run=*")) == len(files(store, "_changes/run=*")) == 1
    assert closes(store) == [("A", "2020-01-02", 1.0)]


def test_runs_with_different_new_companies_do_not_meet(spark, store, monkeypatch):
    store.buckets = 64
    commit, merge, entered, merges = VersionedStore.commit, ingest._merge, [], []

    def interrupted(self, *args):
        if not entered:
            entered.append(1)
            other = VersionedStore(spark, store.root, buckets=64)
            ingest.ingest(other, {"price": prices(spark, ("BBB", "2020-01-02", 2.0))})
        return commit(self, *args)

    def counted(*args):
        merges.append(1)
        return merge(*args)

    monkeypatch.setattr(VersionedStore, "commit", interrupted)
    monkeypatch.setattr(ingest, "_merge", counted)
    ingest.ingest(store, {"price": prices(spark, ("AAA", "2020-01-02", 1.0))})
    assert len(merges) == 2  # one for each run, none done again
    assert closes(store) == [("AAA", "2020-01-02", 1.0), ("BBB", "2020-01-02", 2.0)]
    assert sorted(r.id for r in store.read("company").collect()) == [1, 2]
    ids = {r.symbol: r.id for r in store.read("company").collect()}
    assert {r.symbol: r.company_id for r in store.read("price").collect()} == ids


def test_runs_with_the_same_new_company_give_it_one_id(spark, store, monkeypatch):
    commit, entered = VersionedStore.commit, []

    def interrupted(self, *args):
        if not entered:
            entered.append(1)
            other = VersionedStore(spark, store.root, buckets=2)
            ingest.ingest(other, {"price": prices(spark, ("AAA", "2021-01-02", 2.0))})
        return commit(self, *args)

    monkeypatch.setattr(VersionedStore, "commit", interrupted)
    ingest.ingest(store, {"price": prices(spark, ("AAA", "2020-01-02", 1.0))})
    (company,) = store.read("company").collect()
    assert {r.company_id for r in store.read("price").collect()} == {company.id}
    assert len(closes(store)) == 2


def test_replayed_batch_of_a_stream_writes_nothing(spark, store, tmp_path, monkeypatch):
    landing = tmp_path / "landing" / "price"
    landing.mkdir(parents=True)
    (landing / "a.json").write_text(json.dumps({"symbol": "A", "date": "2020-01-02", "close": 1.5}) + "\n")
    checkpoint = str(tmp_path / "checkpoint")
    real = upsert_stream.ingest

    def dies_after_commit(*args, **of):
        real(*args, **of)
        raise OSError("died between commit and checkpoint")

    monkeypatch.setattr(upsert_stream, "ingest", dies_after_commit)
    with pytest.raises(Exception, match="died between"):
        upsert_stream.stream_upsert_all(store, str(tmp_path / "landing"), checkpoint)
    monkeypatch.undo()
    assert store.current()[0] == 1
    before = files(store, "**/*")

    def unexpected(*_, **__):
        raise AssertionError("a replayed batch is not worked on")

    monkeypatch.setattr(upsert_stream, "ingest", unexpected)
    upsert_stream.stream_upsert_all(store, str(tmp_path / "landing"), checkpoint)
    monkeypatch.undo()
    assert files(store, "**/*") == before
    # Later batches of the stream are taken, and a new checkpoint is a new stream.
    (landing / "b.json").write_text(json.dumps({"symbol": "A", "date": "2020-01-02", "close": 2.5}) + "\n")
    upsert_stream.stream_upsert_all(store, str(tmp_path / "landing"), checkpoint)
    assert closes(store) == [("A", "2020-01-02", 2.5)] and store.current()[0] == 2
    upsert_stream.stream_upsert_all(store, str(tmp_path / "landing"), str(tmp_path / "other"))
    assert closes(store) == [("A", "2020-01-02", 2.5)]


def test_batch_that_the_store_has_taken_is_left_out(spark, store):
    ingest.ingest(store, {"price": prices(spark, ("A", "2020-01-02", 1.0))}, source=("s", 4))
    ingest.ingest(store, {"price": prices(spark, ("A", "2020-01-02", 2.0))}, source=("s", 4))
    assert closes(store) == [("A", "2020-01-02", 1.0)]
    ingest.ingest(store, {"price": prices(spark, ("A", "2020-01-02", 2.0))}, source=("s", 5))
    ingest.ingest(store, {"price": prices(spark, ("A", "2020-01-02", 3.0))}, source=("t", 0))
    assert closes(store) == [("A", "2020-01-02", 3.0)]
    assert store.head().streams == {"s": 5, "t": 0}


def test_scan_of_symbols_lists_their_buckets_only(spark, store):
    store.buckets = 16
    store.put("price", spark.createDataFrame([(f"S{k}", datetime.date(y, 1, 2), float(k)) for k in range(60) for y in (2019, 2020)], "symbol string, date date, close double"))
    wanted = ["S3", "S7", "absent"]
    got = store.read_symbols("price", wanted)
    assert sorted((r.symbol, r.date.year) for r in got.collect()) == [(s, y) for s in ("S3", "S7") for y in (2019, 2020)]
    assert len(got.inputFiles()) <= 6  # three buckets of 16, two years
    as_table = spark.createDataFrame([(s,) for s in [*wanted, "S3"]], "symbol string")
    one_year = store.read_symbols("price", as_table, years=[2020])
    assert sorted(r.symbol for r in one_year.collect()) == ["S3", "S7"]
    assert all("year=2020" in f for f in one_year.inputFiles())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_published_tables_need_no_exchange(spark, store, tables):
    """Reports over a store: nothing stored is shuffled, and a symbol reads one bucket."""
    store.buckets = 8
    names = ("company", "price", "income_statement_quarter", "balance_sheet_quarter", "cash_flow_statement_quarter")
    for table in names:
        store.put(table, tables[table])
    published = {t: store.publish(t, f"published_{t}") for t in names}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for report in (lambda t: reports.ticker_history(t, symbols=None), lambda t: reports.portfolio_ttm(t, min_year=1996)):
            plan = plan_of(report(published))
            assert re.findall(r"Exchange (\w+)", plan) == ["rangepartitioning", "hashpartitioning"], plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows(reports.ticker_history(published, symbols=None)) == rows(reports.ticker_history(tables, symbols=None))
    one = plan_of(reports.ticker_history(published, symbols=["T0000000007"]))
    scans = [line for line in one.splitlines() if "FileScan" in line]
    assert scans and all("SelectedBucketsCount: 1 out of 8" in line for line in scans)
    assert re.search(r"PartitionFilters: \[[^]]*year#", plan_of(published["price"].filter("year = 1996")))
    # A later commit of one year writes that year's partition again and no other.
    ingest.ingest(store, {"price": prices(spark, ("T0000000007", "1996-03-04", 3.25))})
    data = f"_published/published_price/data/**/*.parquet"
    old = set(files(store, data))
    again = store.publish("price", "published_price")
    new = set(files(store, data)) - old
    assert new and all("/year=1996/" in f for f in new)
    assert again.filter("symbol = 'T0000000007' AND date = DATE'1996-03-04'").select("close").collect()[0].close == 3.25
    assert again.count() == store.read("price").count()
    for t in names:
        spark.sql(f"DROP TABLE published_{t}")
