"""Schemas and normalisation."""

import datetime

import pytest

from ledgerlens import schemas
from ledgerlens.operators import normalize
from tests.conftest import rows


def test_column_counts():
    counts = {n: len(schemas.table_schema(n).fields) for n in schemas.TABLES}
    assert counts == {
        "company": 31,
        "income_statement_fy": 40,
        "income_statement_quarter": 40,
        "balance_sheet_fy": 56,
        "balance_sheet_quarter": 56,
        "cash_flow_statement_fy": 42,
        "cash_flow_statement_quarter": 42,
        "shares_fy": 4,
        "price": 9,
    }


def test_catalog():
    assert schemas.table_for("income-statement", "fy") == "income_statement_fy"
    assert schemas.table_for("profile", "quarter") == "company"
    with pytest.raises(ValueError):
        schemas.table_for("profile", "month")
    with pytest.warns(UserWarning, match="nonsense"):
        assert schemas.select_tables(["price", "nonsense"]) == ["price"]
    assert schemas.select_tables([]) == schemas.select_tables(None) == list(schemas.TABLES)
    assert schemas.column_type("company", "mktCap").simpleString() == "bigint"
    assert "id" not in schemas.compared_columns("company")


@pytest.mark.parametrize(
    "dataset, columns, keys",
    [
        ("profile", [], ["symbol"]),
        ("historical-price-eod/full", [], ["symbol", "date"]),
        ("income-statement", ["period"], ["symbol", "calendaryear", "period"]),
        ("income-statement", ["revenue"], ["symbol", "calendaryear"]),
    ],
)
def test_merge_keys(dataset, columns, keys):
    assert schemas.merge_keys(dataset, columns) == keys


def test_empty_tables(spark):
    empty = schemas.empty_tables(spark, ["price"])
    assert list(empty) == ["price"]
    assert empty["price"].count() == 0
    assert empty["price"].columns[:4] == ["id", "company_id", "symbol", "date"]


def test_normalize_batch(spark):
    raw = spark.createDataFrame(
        [
            ("A", "2024-03-31", "2024", "Q1", "12", "1.5", "2024-04-30 16:30:00", "x"),
            ("B", "2024-13-01", "20x", "Q1", "12x", "NaN", "soon", "x"),
        ],
        "symbol string, date string, calendarYear string, period string, revenue string, "
        "epsdiluted string, acceptedDate string, unknown string",
    )
    df = normalize.normalize(raw, "income_statement_quarter")
    assert len(df.columns) == 38 and "unknown" not in df.columns
    got = rows(df.select("symbol", "date", "calendaryear", "revenue", "epsdiluted", "accepteddate", "eps"))
    assert got == [
        ("A", datetime.date(2024, 3, 31), 2024, 12, 1.5, datetime.datetime(2024, 4, 30, 16, 30), None),
        ("B", None, None, None, None, None, None),
    ]


def test_normalize_booleans(spark):
    raw = spark.createDataFrame([("A", "true"), ("B", "false"), ("C", "perhaps")], "symbol string, isEtf string")
    df = normalize.normalize(raw, "company", fill_missing=False)
    assert df.columns == ["symbol", "isetf"]
    assert rows(df) == [("A", True), ("B", False), ("C", None)]


def test_add_columns(spark):
    df = normalize.add_columns(spark.createDataFrame([(1,)], "a int"), {"a": "string", "b": "date"})
    assert df.dtypes == [("a", "int"), ("b", "date")]
