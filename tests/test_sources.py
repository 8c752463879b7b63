"""Readers and writers on small files."""

import datetime
import gzip
import json

import pytest
from pyspark.sql import functions as F

from ledgerlens.sources import readers, writers
from tests.conftest import rows


def test_csv_tree(spark, tmp_path):
    for folder, text in {
        "a": "symbol,date,calendarYear,revenue\nA,2020-12-31,2020,5\nA,bad,2021,x\n",
        "b/c": "symbol,date,calendarYear,revenue\nB,2020-12-31,2020,7\n",
    }.items():
        path = tmp_path / folder
        path.mkdir(parents=True)
        (path / "f.csv").write_text(text)
    (tmp_path / "note.txt").write_text("not a table")
    df = readers.read_csv_tree(spark, str(tmp_path), "income_statement_fy")
    assert rows(df.select("symbol", "date", "calendaryear", "revenue")) == [
        ("A", datetime.date(2020, 12, 31), 2020, 5),
        ("A", None, 2021, None),
        ("B", datetime.date(2020, 12, 31), 2020, 7),
    ]
    assert rows(readers.seed_companies(df)) == [("A",), ("B",)]


def test_csv_tree_with_other_column_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",symbol,revenue,period\n0,A,5,FY\n1,A2,6,\n")
    (tmp_path / "b.csv").write_text('"revenue","symbol"\n"7","B"\n')
    (tmp_path / "c.csv").write_text("symbol,note,revenue\nC,x,\n")
    raw = readers.read_csv_tree(spark, str(tmp_path))
    assert rows(raw.select("symbol", "revenue", "period", "note")) == [
        ("A", "5", "FY", None),
        ("A2", "6", None, None),
        ("B", "7", None, None),
        ("C", None, None, "x"),
    ]
    typed = readers.read_csv_tree(spark, str(tmp_path), "income_statement_fy")
    assert rows(typed.select("symbol", "revenue")) == [("A", 5), ("A2", 6), ("B", 7), ("C", None)]


def test_csv_quotes_wide_files_and_refused_files(spark, tmp_path):
    (tmp_path / "q.csv").write_text('symbol,note,revenue\nA,"a ""q"" b, c",5\nB,plain,6\n')
    wide = ["symbol", *[f"x{i}" for i in range(300)]]
    (tmp_path / "w.csv").write_text(",".join(wide) + "\n" + ",".join(["W", *map(str, range(300))]) + "\n")
    (tmp_path / "t.csv").write_text("ticker,revenue\nT,9\n")
    (tmp_path / "e.csv").write_text("")
    with pytest.warns(UserWarning, match="1 files without column 'symbol'"):
        raw = readers.read_csv_tree(spark, str(tmp_path))
    assert rows(raw.select("symbol", "note", "revenue", "x299")) == [
        ("A", 'a "q" b, c', "5", None),
        ("B", "plain", "6", None),
        ("W", None, None, "299"),
    ]
    assert "Join" not in raw._jdf.queryExecution().toString()


def test_csv_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "m.csv").write_text('symbol,note\nA,"two\nlines"\nB,one\n')
    raw = readers.read_csv_tree(spark, str(tmp_path), multiline=True)
    assert rows(raw.select("symbol", "note")) == [("A", "two\nlines"), ("B", "one")]


def test_csv_tree_without_files(spark, tmp_path):
    (tmp_path / "note.txt").write_text("symbol\nA\n")
    assert readers.read_csv_tree(spark, str(tmp_path), "price").count() == 0


def test_broken_and_compressed_csv_files(spark, tmp_path):
    text = "symbol,revenue\n" + "".join(f"{{0}}{i},{i}\n" for i in range(20_000))
    whole = gzip.compress(text.replace("{0}", "W").encode()) + gzip.compress(b"V,1\n")
    (tmp_path / "w.csv.gz").write_bytes(whole)
    (tmp_path / "plain.csv").write_text("\n \nsymbol,revenue\nP,7\n")
    cut = gzip.compress(text.replace("{0}", "C").encode())
    (tmp_path / "cut1.csv.gz").write_bytes(cut[: len(cut) // 2])
    (tmp_path / "cut2.csv.gz").write_bytes(cut[:-4])
    (tmp_path / "not.csv.gz").write_bytes(b"symbol,revenue\nN,7\n")
    with pytest.warns(UserWarning, match="3 files that break off.*cut1.csv.gz.*cut2.csv.gz.*not.csv.gz"):
        raw = readers.read_csv_tree(spark, str(tmp_path))
    found = raw.groupBy(F.substring("symbol", 1, 1).alias("s")).agg(F.count("*").alias("n"))
    assert rows(found) == [("P", 1), ("V", 1), ("W", 20_000)]


def test_csv_header_of_over_a_megabyte(spark, tmp_path):
    names = [f"c{i}_" + "x" * 9_000 for i in range(150)]
    (tmp_path / "h.csv").write_text(",".join([*names, "symbol"]) + "\n" + ",".join([*map(str, range(150)), "H"]) + "\n")
    (tmp_path / "s.csv").write_text("symbol\nS\n")
    raw = readers.read_csv_tree(spark, str(tmp_path))
    assert rows(raw.select("symbol", names[149])) == [("H", "149"), ("S", None)]


def test_csv_headers_are_not_opened_by_the_driver(spark, tmp_path, monkeypatch):
    for k in range(30):
        (tmp_path / f"{k}.csv").write_text(f"symbol,{'a' if k % 2 else 'b'}\nS{k},{k}\n")
    found = readers.csv_headers(spark, str(tmp_path))
    assert {line: len(paths) for line, paths in found.items()} == {"symbol,a": 15, "symbol,b": 15}


def test_json_records_one_response_per_file(spark, tmp_path):
    records = [
        {"symbol": "A", "date": "2020-03-31", "calendarYear": "2020", "revenue": 5, "eps": 1.5, "new": 1},
        {"symbol": "A", "date": "2020-06-30", "calendarYear": "2020", "revenue": 6},
    ]
    (tmp_path / "a.json").write_text(json.dumps(records, indent=2))
    df = readers.read_json_records(spark, str(tmp_path), "income_statement_quarter")
    assert rows(df.select("symbol", "calendaryear", "revenue", "eps")) == [
        ("A", 2020, 5, 1.5),
        ("A", 2020, 6, None),
    ]


def test_ticker_json_with_backup(spark, tmp_path):
    data = {"0": {"cik_str": 1, "ticker": "A", "title": "Alpha"}, "1": {"ticker": "B"}}
    path = tmp_path / "tickers.json"
    path.write_text(json.dumps(data, indent=1))
    assert rows(readers.read_ticker_json(spark, str(path))) == [("A",), ("B",)]
    with pytest.warns(UserWarning):
        got = readers.read_ticker_json(spark, str(tmp_path / "absent"), backup=str(path))
    assert rows(got) == [("A",), ("B",)]


def test_ticker_list(spark, tmp_path):
    path = tmp_path / "list.txt"
    path.write_text(" aapl\n\n   \nmsft \n")
    assert rows(readers.read_ticker_list(spark, str(path), ["goog"])) == [("AAPL",), ("GOOG",), ("MSFT",)]
    assert readers.read_ticker_list(spark) is None


def test_append_and_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    for symbol in ("A", "B"):
        writers.append_rows(spark.createDataFrame([(symbol, 1)], "symbol string, v int"), path)
    assert spark.read.parquet(path).count() == 2
    scan = readers.scan_table(spark, path, ["A"])
    assert rows(scan) == [("A", 1)]
    assert "In(symbol" in scan._jdf.queryExecution().toString() or "EqualTo(symbol,A)" in (
        scan._jdf.queryExecution().toString()
    )


def test_csv_per_symbol(spark, tmp_path):
    path = tmp_path / "out"
    df = spark.createDataFrame([("A", 1), ("B", 2), ("A", 3)], "symbol string, v int")
    writers.write_csv_per_symbol(df.repartition(3), str(path))
    assert sorted(p.name for p in path.glob("symbol=*")) == ["symbol=A", "symbol=B"]
    assert len(list((path / "symbol=A").glob("*.csv"))) == 1


def test_csv_per_symbol_is_written_by_many_tasks(spark, tmp_path):
    path = tmp_path / "out"
    df = spark.range(200).select(F.concat(F.lit("S"), "id").alias("symbol"), "id")
    writers.write_csv_per_symbol(df, str(path))
    files = list(path.glob("symbol=*/*.csv"))
    assert len(files) == 200
    assert len({f.name.split("-")[1] for f in files}) > 1  # the number of the task


def test_bucket_count():
    assert writers.bucket_count(10) == 8
    assert writers.bucket_count(100_000_000) == 1000
    assert writers.bucket_count(10**12) == writers.MAX_BUCKETS


def test_bucket_count_follows_rows():
    assert writers.bucket_count(10, 1_000) == 8
    assert writers.bucket_count(360_000, 216_000_000) == 432
    assert writers.bucket_count(10, 10**13) == writers.MAX_BUCKETS


def test_buckets_of_derived_tables_follow_the_sales(spark, monkeypatch):
    from ledgerlens.workload.derive import Warehouse

    monkeypatch.setattr(writers, "ROWS_PER_BUCKET", 300)
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    price = Warehouse(spark, "/root/testdata/sf0.001")["price"]
    wanted = -(-lines // 300)
    assert wanted > 8
    assert f"{wanted} buckets" in price._jdf.queryExecution().optimizedPlan().collectLeaves().head().relation().bucketSpec().get().toString()
