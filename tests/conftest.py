from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tempora.session import get_session

    s = get_session("local[*]", 8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def mock(spark):
    from mock_rows import mock_logs

    return mock_logs(spark)


@pytest.fixture(scope="session")
def small_logs(spark):
    from tempora.sources.testdata import cdc_logs

    return cdc_logs(spark, SF_SMALL)
