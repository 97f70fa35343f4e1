from __future__ import annotations

import duckdb
import pytest
from oracle_check import compare

from tempora.llm.oracle import ORACLE
from tempora.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    ok, why = compare(QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE[name]).fetchdf())
    assert ok, why


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_alias_sql_equals_operator(spark):
    from test_urls import PAGES, pages

    from tempora.llm.urls import filter_urls, rules_table

    df = pages(spark, [p for p in PAGES if p[0] is not None])
    con = duckdb.connect()
    con.register("pages", df.toPandas())
    ok, why = compare(filter_urls(df, rules_table(spark)).toPandas(), con.execute(ORACLE["op6_url_filter"]).fetchdf())
    assert ok, why
