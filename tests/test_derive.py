"""Derived tables: what is exchanged for them, and their values on odd rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlens.workload import derive
from tests.conftest import rows

LINES = (
    "l_suppkey long, l_shipdate timestamp, l_extendedprice double, l_discount double, l_tax double, l_quantity double, "
    "l_returnflag string, l_linestatus string, l_linenumber int"
)


def sale(key, day, price, discount=0.05, tax=0.02, quantity=2.0, flag="R", status="O", number=7):
    at = day and datetime.datetime.fromisoformat(day)
    return key, at, price, discount, tax, quantity, flag, status, number


@pytest.fixture
def sf_dir(spark, tmp_path):
    data = [
        sale(1, "1996-01-02", 10.0),
        sale(1, "1996-01-02", 30.0, quantity=4.0),
        sale(1, "1996-03-02", 5.0, discount=None, status="F", number=1),
        sale(1, "2000-02-01", 7.0, tax=None, status="F", flag=None),
        sale(1, "2000-02-02", 9.0, discount=None, tax=None, status=None, number=None),
        sale(2, "2000-02-02", None, quantity=None),
        sale(None, "1996-01-02", 4.0),
        sale(2, None, 4.0),
    ]
    spark.createDataFrame(data, LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    suppliers = [(1, "one", 0, 1000.0), (2, "two", 0, 1000.0)]
    spark.createDataFrame(suppliers, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(0, "A", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(0, "EUROPE")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    return str(tmp_path)


@pytest.fixture
def written(monkeypatch):
    """Plans of the derived tables, by name, as they are written."""
    plans, write = {}, derive.write_bucketed

    def kept(df, table, path, buckets, sort=()):
        plan = df.repartition(buckets, "symbol")._jdf.queryExecution().executedPlan().toString()
        plans[table.split("_", 2)[2]] = plan.split("== Initial Plan ==")[0]
        return write(df, table, path, buckets, sort=sort)

    monkeypatch.setattr(derive, "write_bucketed", kept)
    return plans


def test_sales_are_exchanged_once_for_prices(spark, sf_dir, written):
    price = derive.Warehouse(spark, sf_dir)["price"]
    assert written["price"].count("Exchange") == 1
    day = datetime.date(1996, 1, 2)
    got = rows(price.filter(F.col("date") == day).select("symbol", "company_id", "high", "low", "close", "volume"))
    assert got == [("T0000000001", 2, 7.5, 5.0, 4000.0 / 6 / 100, 2), (None, None, 2.0, 2.0, 2.0, 1)]
    assert price.count() == 7


def test_both_states_of_the_quarters_read_the_sales_once(spark, sf_dir, written):
    tables = derive.Warehouse(spark, sf_dir)
    assert {tables["snapshot_old"].count(), tables["statement_quarter"].count()} == {2, 5}
    assert [n for n, plan in written.items() if "l_extendedprice" in plan] == ["quarter_part"]
    for name in ("snapshot_old", "statement_quarter"):
        assert "Exchange hashpartitioning" not in written[name]


def test_quarters_with_missing_amounts(spark, sf_dir):
    """Each column is the sum of its own products; a missing amount leaves out those it is in."""
    c, disc, tax = F.col("c"), F.col("disc"), F.col("tax")
    no = F.lit(0).cast("bigint")
    plain = {
        "revenue": c * 100,
        "costofrevenue": c * (disc + 50),
        "ebitda": c * (50 - disc),
        "depreciationandamortization": c * tax,
        "operatingincome": c * (50 - disc - tax),
        "interestexpense": F.when(F.col("l_returnflag") == "R", c * 9).otherwise(no),
        "netincome": c * (40 - disc - tax),
        "weightedaverageshsoutdil": F.col("qty") * 1000,
        "totalassets": c * 300,
        "totalcurrentliabilities": c * (tax + 60),
        "cashandcashequivalents": c * 20,
        "longtermdebt": F.when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 7), c).otherwise(no),
        "operatingcashflow": c * (45 - disc),
        "freecashflow": c * (16 - disc * 2),
        "stockbasedcompensation": c * F.when(F.col("l_linenumber") == 1, 12).otherwise(2),
    }
    lines = derive.sales(spark, sf_dir)
    end = F.last_day(F.add_months(F.trunc("d", "quarter"), 2))
    wanted = lines.groupBy((F.col("l_suppkey") + 1).alias("company_id"), end.alias("date"))
    wanted = wanted.agg(*[F.sum(e).alias(n) for n, e in plain.items()])
    got = derive.quarter_statements(derive.quarter_parts(lines)).select(wanted.columns)
    assert rows(got) == rows(wanted)
    assert got.count() == 5
    known = derive.quarter_statements(derive.quarter_parts(lines).filter("known"))
    assert rows(known.select("company_id", "date", "revenue")) == [
        (2, datetime.date(1996, 3, 31), 450000),
        (2, datetime.date(2000, 3, 31), 70000),
        (None, datetime.date(1996, 3, 31), 40000),
    ]
