"""The registered queries: names, and those that SQL can state against DuckDB."""

import os

import duckdb
import pytest

from ledgerlens.llm import catalog

SF_DIR = "/root/testdata/sf0.001"


def test_names():
    numbers = sorted(int(name[2:].split("_")[0]) for name in catalog.QUERIES)
    assert numbers == list(range(1, len(numbers) + 1))
    assert set(catalog.SQL) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", catalog.SQL)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    result = con.execute(catalog.SQL[name])
    columns = [d[0] for d in result.description]
    df = catalog.QUERIES[name](spark, SF_DIR)
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(tuple, df.select(columns).collect()), key=str) == sorted(result.fetchall(), key=str)


#: queries whose rows are those of another table or none
NOT_BY_DOCUMENT = {"op12_embedding_whitening"}


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL) - NOT_BY_DOCUMENT))
def test_other_queries_give_a_row_for_each_document(spark, name):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = catalog.QUERIES[name](spark, SF_DIR)
    assert sorted(r[0] for r in got.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())
