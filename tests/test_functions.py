"""Metric, date and value expressions on hand-made rows."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from ledgerlens.functions import dates, values
from ledgerlens.functions import metrics as m
from tests.conftest import rows

D = datetime.date


def one(spark, schema, data, *columns):
    return tuple(spark.createDataFrame([data], schema).select(*columns).first())


STATEMENT = (
    "ebitda long, depreciationandamortization long, totalassets long, totalcurrentliabilities long, "
    "operatingincome long, interestexpense long, revenue long, costofrevenue long, "
    "operatingcashflow long, netincome long, freecashflow long, stockbasedcompensation long"
)


def test_metrics(spark):
    got = one(
        spark, STATEMENT, (50, 10, 300, 100, 30, 5, 200, 120, 60, 40, 25, 5),
        *m.company_metrics().values(),
    )
    assert got == (20.0, 6.0, 40.0, 20.0, 150.0, 20)


def test_metrics_with_zero_denominators(spark):
    got = one(
        spark, STATEMENT, (50, 10, 100, 100, 30, 0, 0, 120, 60, 0, 25, 5),
        *m.company_metrics().values(),
    )
    assert got == (None, None, None, None, None, 20)


@pytest.mark.parametrize(
    "expense, strict, loose", [(5, 6.0, 6.0), (0, None, None), (-5, None, -6.0), (None, None, None)]
)
def test_interest_coverage_variants(spark, expense, strict, loose):
    got = one(
        spark, "operatingincome long, interestexpense long", (30, expense),
        m.interest_coverage(), m.interest_coverage_nullif(),
    )
    assert got == (strict, loose)


def test_yield_and_score(spark):
    got = one(
        spark, "fcf long, shares long, price double, z double", (50, 10, 20.0, 0.0),
        m.market_cap("shares", "price"),
        m.adj_fcf_yield("fcf", "shares", "price"),
        m.adj_fcf_yield("fcf", "shares", "z"),
        m.quality_score(F.lit(10.0), F.lit(50.0), F.lit(20.0)),
        m.pct_change_from(F.lit(8.0), F.lit(10.0)),
        m.pct_change_from(F.lit(0.0), F.lit(10.0)),
    )
    assert got == (200.0, 25.0, None, 50.0, 25.0, None)


@pytest.mark.parametrize(
    "first, last, nonneg, pos",
    [
        (1, 32, 100.0, 100.0),
        (0, 32, None, None),
        (-1, 32, None, None),
        (32, None, None, None),
        (32, 0, -100.0, None),
    ],
)
def test_cagr_endpoints(spark, first, last, nonneg, pos):
    a, z = "first_x", "last_x"
    got = one(
        spark, "first_x long, last_x long", (first, last),
        F.round(m.cagr(m.guard_nonneg(z), m.guard_nonneg(a)), 9),
        F.round(m.cagr(m.guard_pos(z), m.guard_pos(a)), 9),
    )
    assert got == (nonneg, pos)


def test_weekend_roll(spark):
    days = [D(2024, 1, 5), D(2024, 1, 6), D(2024, 1, 7), D(2024, 1, 8)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r[0]: r[1] for r in df.select("d", dates.weekend_roll("d")).collect()}
    assert got == {
        days[0]: days[0],
        days[1]: days[0],
        days[2]: days[0],
        days[3]: days[3],
    }


def test_age_buckets(spark):
    cases = {
        D(2024, 6, 1): "3_years",
        D(2021, 6, 1): "3_years",
        D(2021, 5, 31): "5_years",
        D(2014, 6, 1): "10_years",
        D(2009, 6, 1): "15_years",
        D(2004, 6, 1): "20_years",
        D(2004, 5, 31): None,
    }
    df = spark.createDataFrame([(d,) for d in cases], "d date")
    bucket = dates.age_bucket("d", "2024-06-01")
    got = {r[0]: r[1] for r in df.select("d", bucket).collect()}
    assert got == cases
    assert df.select(dates.bucket_years(bucket).alias("n")).filter("n is null").count() == 1


@pytest.mark.parametrize(
    "new, old, expected",
    [
        (1.23451, 1.23452, False),
        (1.2347, 1.2345, True),
        (5e-12, 1e-12, False),
        (None, 5.0, False),
        (5.0, None, True),
        (None, None, False),
    ],
)
def test_differs_floating(spark, new, old, expected):
    got = one(spark, "n double, o double", (new, old),
              values.differs(F.col("n"), F.col("o"), DoubleType()))
    assert bool(got[0]) is expected


@pytest.mark.parametrize(
    "new, old, expected",
    [(10**15, 10**15 + 1, True), (7, 7, False), (None, 7, False), (7, None, True)],
)
def test_differs_integral(spark, new, old, expected):
    got = one(spark, "n long, o long", (new, old),
              values.differs(F.col("n"), F.col("o"), LongType()))
    assert bool(got[0]) is expected


def test_parse_date(spark):
    texts = ["2024-01-02", "2024-01-02 03:04:05", "2024-13-01", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(values.parse_date(F.col("t"))).collect()]
    assert got == [D(2024, 1, 2), D(2024, 1, 2), None, None, None]


def test_clean_ticker(spark):
    df = spark.createDataFrame([(" msft\t",), ("BRK.b\r",)], "s string")
    assert rows(df.select(values.clean_ticker("s"))) == [("BRK.B",), ("MSFT",)]
