"""Physical plans: what the reports read, and that nothing is shuffled for a join."""

import re

import pytest

from ledgerlens.plans import reports
from ledgerlens.workload.derive import Warehouse


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def merge_joins(spark):
    """Plans as for large tables: no side is small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


REPORTS = {
    "portfolio_ttm": lambda t: reports.portfolio_ttm(t, min_year=1996),
    "portfolio_fy": lambda t: reports.portfolio_fy(t, min_year=1996),
    "ticker_history": lambda t: reports.ticker_history(t, symbols=None),
    "yield_vs_history": lambda t: reports.yield_vs_history(t, as_of="2002-01-01"),
    "screen_median_cagr": lambda t: reports.screen_median_cagr(t, min_year=1996),
    "screen_median_roce": lambda t: reports.screen_median_roce(t, min_year=1996),
    "screen_ttm_quality": lambda t: reports.screen_ttm_quality(t, after_year=1996),
    "below_cash_value": lambda t: reports.below_cash_value(t, country=None),
}


@pytest.mark.parametrize("name", REPORTS)
def test_only_the_result_is_shuffled(tables, merge_joins, name):
    plan = plan_of(REPORTS[name](tables))
    exchanges = re.findall(r"Exchange (\w+)", plan)
    # one to hold the finished rows, one to order them
    assert exchanges == ["rangepartitioning", "hashpartitioning"], plan
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and "Python" not in plan


def test_statement_join_and_window_need_no_sort(tables, merge_joins):
    base = reports.statement_base(tables, "quarter")
    plan = plan_of(reports.quarterly_metrics(base))
    assert plan.count("SortMergeJoin") == 2 and plan.count("Window [") == 1
    assert "Exchange" not in plan and not re.search(r"Sort \[", plan)


def test_symbol_filter_reads_one_bucket(tables):
    plan = plan_of(reports.ticker_history(tables, symbols=["T0000000007"]))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    # three statements, and prices once by themselves and twice for the edges of slices
    assert len(scans) == 6
    for scan in scans:
        assert "SelectedBucketsCount: 1 out of 8" in scan


def test_scan_reads_needed_columns_only(tables):
    plan = plan_of(reports.current_adj_fcf_yield(tables, symbols=None))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    names = {c.split(":")[0] for s in schemas for c in s.split(",")}
    assert names <= {
        "symbol", "date", "close", "freecashflow", "stockbasedcompensation",
        "weightedaverageshsoutdil",
    }


def test_reports_without_shared_folder(spark, tables, monkeypatch):
    """On a cluster without a shared folder the derived tables stay plans."""
    monkeypatch.setattr("ledgerlens.workload.derive.shared_root", lambda _: None)
    lazy = Warehouse(spark, tables.sf_dir)
    wanted = {tuple(r) for r in reports.portfolio_fy(tables, min_year=1996).collect()}
    assert {tuple(r) for r in reports.portfolio_fy(lazy, min_year=1996).collect()} == wanted
    assert wanted


def test_require_full_window(tables):
    partial = reports.ticker_history(tables, symbols=None)
    full = reports.ticker_history(tables, symbols=None, require_full_window=True)
    companies = partial.select("symbol").distinct().count()
    assert partial.filter("adj_fcf IS NULL").count() == 0
    assert full.filter("adj_fcf IS NULL").count() == 3 * companies


def test_yield_of_one_symbol_is_that_of_the_whole(tables):
    whole = {r.symbol: r.adj_fcf_yield for r in reports.current_adj_fcf_yield(tables, None).collect()}
    one = reports.current_adj_fcf_yield(tables, ["T0000000003"]).collect()
    assert [(r.symbol, r.adj_fcf_yield) for r in one] == [("T0000000003", whole["T0000000003"])]
