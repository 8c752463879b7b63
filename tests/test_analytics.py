"""Joins, windows, growth and the as-of lookup, against brute force where it helps."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import asof, growth, statements, windows
from tests.conftest import rows

D = datetime.date


def day(n):
    return D(2020, 1, 1) + datetime.timedelta(n)


def quotes(spark, data):
    return spark.createDataFrame(data, "symbol string, date date, close double")


def asked(spark, data):
    return spark.createDataFrame(data, "symbol string, date date, v int")


def test_nearest_price_cases(spark):
    price = quotes(
        spark,
        [("A", day(0), 1.0), ("A", day(10), 2.0), ("B", day(5), 3.0), ("D", day(4), 4.0), ("D", day(6), 6.0)],
    )
    df = asked(
        spark,
        [("A", day(-9), 1), ("A", day(4), 2), ("A", day(6), 3), ("A", day(10), 4), ("A", day(99), 5),
         ("B", day(0), 6), ("C", day(0), 7), ("D", day(5), 8)],
    )
    got = {r.v: (r.price_date, r.close) for r in asof.nearest_price(df, price).collect()}
    assert got == {
        1: (day(0), 1.0),
        2: (day(0), 1.0),
        3: (day(10), 2.0),
        4: (day(10), 2.0),
        5: (day(10), 2.0),
        6: (day(5), 3.0),
        7: (None, None),
        8: (day(4), 4.0),  # tie: the earlier date
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("repeated", [False, True])
def test_nearest_price_against_brute_force(spark, seed, repeated):
    rnd = random.Random(seed)
    symbols = ["A", "B", "C", "D"]
    priced = sorted({(rnd.choice(symbols[:3]), day(rnd.randrange(60))) for _ in range(40)})
    price = quotes(spark, [(s, d, float(i)) for i, (s, d) in enumerate(priced)])
    wanted = [(rnd.choice(symbols), day(rnd.randrange(-5, 70)), i) for i in range(120)]
    if not repeated:
        wanted = [(s, d, i) for i, (s, d) in enumerate(sorted({(s, d) for s, d, _ in wanted}))]
    found = asof.nearest_price(asked(spark, wanted), price, repeated_dates=repeated).collect()
    expected = {}
    for s, d, v in wanted:
        near = sorted((abs((p - d).days), p) for q, p in priced if q == s)
        expected[v] = near[0][1] if near else None
    assert {r.v: r.price_date for r in found} == expected
    assert len(found) == len(wanted)


SLICES = {
    "years": F.year,
    "quarters": lambda d: F.year(d) * 4 + F.quarter(d),
    "ten days": lambda d: F.floor(F.datediff(d, F.lit(D(1990, 1, 1))) / 10),
    "one": lambda d: F.lit(1),
}


@pytest.mark.parametrize("slices", SLICES)
def test_nearest_price_across_slices(spark, slices):
    """Years without a price, without a row, and with neither; edges come from far slices."""
    rnd = random.Random(len(slices))
    priced = sorted({(rnd.choice("ABC"), day(rnd.randrange(-9000, 9000))) for _ in range(60)} | {("D", day(0)), ("E", day(-5000)), ("E", day(5000))})
    price = quotes(spark, [*[(s, d, float(i)) for i, (s, d) in enumerate(priced)], ("A", None, 5.0)])
    wanted = sorted({(rnd.choice("ABCDEF"), day(rnd.randrange(-9500, 9500))) for _ in range(400)} | {("E", day(0))})
    df = asked(spark, [(s, d, i) for i, (s, d) in enumerate(wanted)] + [("A", None, -1)])
    found = {r.v: r.price_date for r in asof.nearest_price(df, price, slice_of=SLICES[slices]).collect()}
    assert found.pop(-1) is None
    for i, (s, d) in enumerate(wanted):
        near = min(((abs((p - d).days), p) for q, p in priced if q == s), default=(None, None))
        assert found.pop(i) == near[1]
    assert not found


def test_nearest_price_splits_a_symbol_of_many_rows(spark):
    """No task holds the rows of a symbol: they are dealt by symbol and year."""
    dates = F.expr("date_add(DATE'1900-01-01', CAST(id AS INT))")
    price = spark.range(40_000).select(F.lit("A").alias("symbol"), dates.alias("date"), F.col("id").cast("double").alias("close"))
    df = price.select("symbol", "date")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        found = asof.nearest_price(df, price)
        assert found.filter("price_date = date").count() == 40_000
        tasks = found.groupBy(F.spark_partition_id().alias("task")).agg(F.count("price_date").alias("rows")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # 110 years over 32 tasks: some hold several years, none a large share.
    assert sum(r["rows"] for r in tasks) == 40_000 and max(r["rows"] for r in tasks) <= 12 * 366


def test_exact_price_rolls_back_from_weekend(spark):
    price = quotes(spark, [("A", D(2024, 1, 5), 1.0), ("A", D(2024, 1, 6), 9.0)])
    df = asked(spark, [("A", D(2024, 1, 7), 1), ("A", D(2024, 1, 8), 2)])
    got = asof.exact_price(df, price).collect()
    assert [(r.v, r.adj_date, r.close) for r in got] == [(1, D(2024, 1, 5), 1.0)]


FACTS = "symbol string, company_id long, date date, x long"


def facts(spark, data):
    return spark.createDataFrame(data, FACTS)


def test_ttm_partial_and_full(spark):
    df = facts(spark, [("A", 1, day(n), n + 1) for n in range(5)] + [("B", 2, day(0), 7)])
    got = windows.ttm(df, flows=["x"]).orderBy("symbol", "date")
    assert [r.x for r in got.collect()] == [1, 3, 6, 10, 14, 7]
    full = windows.ttm(df, flows=["x"], require_full_window=True).orderBy("symbol", "date")
    assert [r.x for r in full.collect()] == [None, None, None, 10, 14, None]


def test_medians(spark):
    df = facts(spark, [("A", 1, day(n), v) for n, v in enumerate([1, 3, 9, 11])])
    got = df.groupBy("symbol").agg(growth.median_disc("x"), growth.median_cont("x")).first()
    assert tuple(got) == ("A", 3, 6.0)


def test_summarise_and_cagr(spark):
    df = facts(
        spark,
        [("A", 1, day(0), 1), ("A", 1, day(1), 5), ("A", 1, day(2), 32), ("B", 2, day(0), 0), ("B", 2, day(1), 9)],
    )
    summary = growth.summarise(df, ["symbol"], ["x"], ["x"])
    assert rows(summary) == [("A", 5, 1, 32), ("B", 0, 0, 9)]
    assert dict(summary.dtypes)["median_x"] == "bigint"
    rated = growth.add_cagr(summary, {"x": "rate"}).withColumn("rate", F.round("rate", 9))
    assert [(r.symbol, r.rate) for r in rated.orderBy("symbol").collect()] == [("A", 100.0), ("B", None)]
    assert rows(summary.filter(growth.endpoints_positive(["x"])).select("symbol")) == [("A",)]


def test_latest_rows_keep_ties(spark):
    df = facts(spark, [("A", 1, day(0), 1), ("A", 1, day(1), 2), ("A", 1, day(1), 3)])
    assert sorted(r.x for r in statements.latest_rows(df).collect()) == [2, 3]


def test_keep_symbols(spark):
    df = facts(spark, [("A", 1, day(0), 1), ("B", 2, day(0), 2)])
    listed = spark.createDataFrame([("A",), ("A",)], "symbol string")
    for wanted in (["A", "A"], listed, ["A", *[f"Z{i}" for i in range(200)]]):
        assert rows(statements.keep_symbols(df, wanted).select("x")) == [(1,)]
    assert statements.keep_symbols(df, None) is df


def test_statement_join_drops_unmatched(spark):
    def statement(name, days):
        return spark.createDataFrame([("A", 1, day(n), n) for n in days], f"symbol string, company_id long, date date, {name} long")

    joined = statements.join_statements(
        statement("i", [0, 1, 2]), statement("b", [1, 2, 3]), statement("c", [2, 3])
    )
    assert rows(joined) == [("A", 1, day(2), 2, 2, 2)]
