"""Every registered query against its DuckDB oracle on sf0.001 (the driver
runs the same comparison at sf0.01)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck
from tempora.plans.oracle import build

SF = "/root/testdata/sf0.001"
# The streaming and sink keys are exercised in their own, slower tests.
# The optional training-data queries have tests of their own in tests/llm.
OWN = build()
FAST = [k for k in OWN if not k.startswith("stream_")]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    ok, msg = compare(got, want)
    assert ok, msg


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
    assert all(k in OWN or k == "pipeline" or k.startswith("op") for k in E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 436
    assert df.columns == ["transaction_date", "subsidiary", "as_of_date", "gmv_amount", "purchases_count",
                          "source_max_ingestion_ts", "run_id"]
