"""Golden results of the hand-made scenario (both runs, current view, margin)."""

from __future__ import annotations

import datetime as dt
import decimal

import pytest

from mock_rows import GOLDEN_MARGIN, GOLDEN_SNAPSHOTS
from tempora.functions.rules import RunParams
from tempora.operators.gmv import gmv_snapshot, multi_snapshot
from tempora.operators.margin import contribution_margin
from tempora.session import scratch_path
from tempora.sinks.gold import GoldTable, SnapshotError


def _gold_rows(df):
    return sorted(
        (r.as_of_date.isoformat(), r.transaction_date.isoformat(), r.subsidiary, str(r.gmv_amount),
         r.purchases_count, r.source_max_ingestion_ts.isoformat(sep=" "), r.run_id)
        for r in df.collect())


RUNS = [RunParams.for_day("2023-01-07"), RunParams.for_day("2023-01-10")]


def test_run_params():
    r = RUNS[0]
    assert r.cutoff_ts == dt.datetime(2023, 1, 8)
    assert r.run_id == "2023-01-07_d-1"


def test_two_snapshots_golden(mock):
    got = []
    for r in RUNS:
        got += _gold_rows(gmv_snapshot(mock, r))
    assert sorted(got) == sorted(GOLDEN_SNAPSHOTS)


def test_multi_snapshot_equals_single_runs(mock):
    assert _gold_rows(multi_snapshot(mock, RUNS)) == sorted(GOLDEN_SNAPSHOTS)


def test_gold_store_current_and_as_of(spark, mock):
    g = GoldTable(spark, scratch_path(spark, "test-gold"))
    for r in RUNS:
        g.append(gmv_snapshot(mock, r))
    assert _gold_rows(g.history()) == sorted(GOLDEN_SNAPSHOTS)
    cur = _gold_rows(g.current())
    assert cur == sorted(x for x in GOLDEN_SNAPSHOTS if x[0] == "2023-01-10")
    first = _gold_rows(g.as_of("2023-01-07"))
    assert first == sorted(x for x in GOLDEN_SNAPSHOTS if x[0] == "2023-01-07")
    assert g.latest_as_of_date().first()[0] == dt.date(2023, 1, 10)
    # the analyst on 2023-01-08 saw the first snapshot
    assert _gold_rows(g.as_seen_on("2023-01-08")) == first


def test_rerun_is_refused_and_old_files_untouched(spark, mock):
    import os

    g = GoldTable(spark, scratch_path(spark, "test-guard"))
    g.append(gmv_snapshot(mock, RUNS[0]))
    folder = os.path.join(g.path.removeprefix("file:"), "as_of_date=2023-01-07")
    before = {f: os.path.getmtime(os.path.join(dp, f)) for dp, _, fs in os.walk(folder) for f in fs}
    with pytest.raises(SnapshotError):
        g.append(gmv_snapshot(mock, RUNS[0]))
    g.append(gmv_snapshot(mock, RUNS[1]))
    after = {f: os.path.getmtime(os.path.join(dp, f)) for dp, _, fs in os.walk(folder) for f in fs}
    assert before == after
    assert g.collisions(gmv_snapshot(mock, RUNS[1])).count() == 2


def test_null_subsidiary_is_refused(spark, mock):
    from pyspark.sql import functions as F

    g = GoldTable(spark, scratch_path(spark, "test-null"))
    bad = gmv_snapshot(mock, RUNS[0]).withColumn("subsidiary", F.lit(None).cast("string"))
    with pytest.raises(SnapshotError):
        g.append(bad)
    assert not g.exists()


def test_margin_golden(mock):
    got = []
    for cutoff in ("2023-01-11 00:00:00", "2023-01-08 00:00:00"):
        for r in contribution_margin(mock, cutoff).collect():
            got.append((cutoff, r.transaction_date.isoformat(), r.subsidiary, str(r.gmv), str(r.cost),
                        str(r.contribution_margin)))
    assert sorted(got) == sorted(GOLDEN_MARGIN)


def test_margin_is_ordered_nulls_last(mock):
    rows = contribution_margin(mock, "2023-01-11 00:00:00").collect()
    keys = [(r.transaction_date, r.subsidiary) for r in rows]
    assert keys == sorted(keys)
    assert all(isinstance(r.gmv, decimal.Decimal) for r in rows)
