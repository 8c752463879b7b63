"""Work lists and date chunks."""

import datetime

import pytest

from ledgerlens.operators import manifest
from tests.conftest import rows

D = datetime.date


def chunks(spark, start, end, days=4900):
    df = spark.createDataFrame([("A", start, end)], "symbol string, param_from date, param_to date")
    found = manifest.date_chunks(df, max_days=days).orderBy("chunk_no").collect()
    return [(r.chunk_from, r.chunk_to) for r in found]


@pytest.mark.parametrize(
    "start, end, expected",
    [
        (D(2000, 1, 1), D(2000, 1, 1), []),
        (D(2000, 1, 2), D(2000, 1, 1), []),
        (D(2000, 1, 1), D(2000, 1, 11), [(D(2000, 1, 1), D(2000, 1, 11))]),
        # a single day left over gives no chunk
        (D(2000, 1, 1), D(2000, 1, 12), [(D(2000, 1, 1), D(2000, 1, 11))]),
        (D(2000, 1, 1), D(2000, 1, 13), [(D(2000, 1, 1), D(2000, 1, 11)), (D(2000, 1, 12), D(2000, 1, 13))]),
    ],
)
def test_chunks_of_ten_days(spark, start, end, expected):
    assert chunks(spark, start, end, 10) == expected


@pytest.mark.parametrize("end", [D(2026, 11, 30), D(1913, 6, 2), D(1913, 6, 3), D(1913, 6, 4), D(1999, 1, 1)])
def test_chunks_tile_the_range(spark, end):
    start, day = D(1900, 1, 1), datetime.timedelta(1)
    found = chunks(spark, start, end)
    assert found[0][0] == start
    assert all(a < b and (b - a).days <= 4900 for a, b in found)
    assert all(then[0] == before[1] + day for before, then in zip(found, found[1:], strict=False))
    assert end - found[-1][1] <= day


def test_chunk_examples(spark):
    assert len(chunks(spark, D(1900, 1, 1), D(2026, 11, 30))) == 10
    # a single day left over at the end gives no chunk
    assert chunks(spark, D(2000, 1, 1), D(2000, 1, 12), 10) == [(D(2000, 1, 1), D(2000, 1, 11))]


def test_union_chunks_keeps_first(spark):
    schema = "symbol string, date date, close double"
    one = spark.createDataFrame([("A", D(2000, 1, 1), 1.0), ("A", D(2000, 1, 2), 2.0)], schema)
    two = spark.createDataFrame([("A", D(2000, 1, 2), 9.0), ("A", D(2000, 1, 3), 3.0)], schema)
    got = rows(manifest.union_chunks([one, two], ["symbol", "date"]))
    assert [r[2] for r in got] == [1.0, 2.0, 3.0]


def test_dedup_limits_before_shuffle(spark):
    df = spark.range(1000).selectExpr("concat('S', id % 3) AS symbol", "id AS v")
    plan = manifest.first_row_per_key(df, ["symbol"], ["v"])._jdf.queryExecution().toString()
    partial = plan.index("row_number(), 1, Partial")
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange hashpartitioning") < partial


def test_manifest(spark):
    tickers = spark.createDataFrame([("A",), ("B",)], "symbol string")
    assert manifest.manifest(tickers).count() == 2 * 8
    assert manifest.manifest(tickers, "quarter").count() == 2 * 5
    only = manifest.manifest(tickers, "fy", ["income-statement"])
    assert rows(only)[0] == ("A", "income-statement", "fy", "income_statement_fy")
    with pytest.raises(ValueError):
        manifest.manifest(tickers, "weekly")


def test_default_params():
    assert manifest.default_params("income-statement", "fy") == {"period": "fy"}
    assert manifest.default_params("profile", "fy") == {}
    got = manifest.default_params("historical-price-eod/full", "fy", D(2020, 1, 1))
    assert got == {"from": "1900-01-01", "to": "2020-01-01"}
    with pytest.raises(ValueError):
        manifest.default_params("profile", "all")


def test_uncovered(spark):
    work = manifest.manifest(spark.createDataFrame([("A",), ("B",)], "symbol string"), "fy", ["profile"])
    landed = spark.createDataFrame([("A", "profile")], "symbol string, dataset string")
    assert [r[0] for r in rows(manifest.uncovered(work, landed, ["symbol", "dataset"]))] == ["B"]
