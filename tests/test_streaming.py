"""Streaming paths equal the batch results (sf0.001, availableNow)."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from oracle_check import compare, duck
from tempora import schemas as S
from tempora.functions.rules import RunParams
from tempora.operators.latest import latest_as_of
from tempora.plans.queries import RUN1, RUN2
from tempora.session import scratch_path
from tempora.sinks.notes import delete
from tempora.sources import testdata as TD
from tempora.streaming.ingest import land
from tempora.streaming.queries import _drops
from tempora.streaming.state import StateStream

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["stream_bronze", "stream_latest_state", "stream_state_as_of", "stream_daily_snapshot"])
def test_stream_equals_batch(spark, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = duck(SF).execute(E.oracle_sql()[name]).df()
    ok, msg = compare(got, want)
    assert ok, msg


def _rows(df, cols):
    return sorted(map(str, df.select(*cols).collect()))


def _pieces(spark):
    log = TD.purchase_cdc(spark, SF)
    first, second, third = _drops(log)
    late = "purchase_id % 7 = 1"  # a seventh of the first drop comes with the last one
    return log, first.where(f"NOT ({late})"), second, third.unionByName(first.where(late))


def test_states_as_of_equal_the_batch_pick_after_late_deliveries(spark):
    root = scratch_path(spark, "test-states")
    landing, state = os.path.join(root, "landing"), StateStream(spark, S.PURCHASE, os.path.join(root, "state"))
    log, *pieces = _pieces(spark)
    cols, last_day = sorted(log.columns), RunParams.for_day("1999-12-31")
    for d in pieces:
        land(d, landing)
        state.advance(landing)
        state.emit_due([RUN1.as_of_date, RUN2.as_of_date, last_day.as_of_date])
    for run in (RUN2, last_day):  # due after the last drop
        assert _rows(state.as_of(run.as_of_date), cols) == _rows(latest_as_of(log, S.PURCHASE_KEY, run.cutoff_ts), cols)
    # due after the second drop
    assert _rows(state.as_of(RUN1.as_of_date), cols) == _rows(latest_as_of(pieces[0], S.PURCHASE_KEY, RUN1.cutoff_ts), cols)
    assert _rows(state.current(), cols) == _rows(latest_as_of(log, S.PURCHASE_KEY), cols)
    assert state.emit_due([RUN1.as_of_date]) == []


def test_closed_days_leave_the_state_store_and_late_rows_are_kept(spark):
    root = scratch_path(spark, "test-watermark")
    landing, state = os.path.join(root, "landing"), StateStream(spark, S.PURCHASE, os.path.join(root, "state"), dt.timedelta(hours=36))
    log, *pieces = _pieces(spark)
    held = []
    for d in pieces:
        land(d, landing)
        progress = state.advance(landing)
        operator = progress["stateOperators"][0]
        assert operator["numRowsDroppedByWatermark"] == 0
        held.append(operator["numRowsTotal"])
        top = state.watermark()
        timely = log.where(F.col("ingestion_ts") >= F.date_trunc("day", F.lit(str(top)).cast("timestamp_ntz")))
        assert operator["numRowsTotal"] <= timely.count()  # open days only
    assert max(held) < log.count() / 10
    mark = pieces[0].unionByName(pieces[1]).agg(F.max("ingestion_ts")).first()[0] - dt.timedelta(hours=36)
    behind = F.date_add(F.to_date("ingestion_ts"), 1).cast("timestamp_ntz") <= F.lit(str(mark)).cast("timestamp_ntz")
    assert _rows(state.late.read(), sorted(log.columns)) == _rows(pieces[2].where(behind), sorted(log.columns))
    state.emit_due(["2000-01-01"])
    assert state.late.read() is None  # folded into the state, as are the closed days
    assert state.days.read() is None or state.days.read().where("arrival_day <= '2000-01-01'").count() < log.count() / 2
    assert _rows(state.current(), sorted(log.columns)) == _rows(latest_as_of(log, S.PURCHASE_KEY), sorted(log.columns))


def test_a_repeated_batch_is_routed_as_the_first_time(spark):
    root = scratch_path(spark, "test-reroute")
    landing, state = os.path.join(root, "landing"), StateStream(spark, S.PURCHASE, os.path.join(root, "state"))
    log, *pieces = _pieces(spark)
    for d in pieces:
        land(d, landing)
        state.advance(landing)
    before = state.late.read().count()
    delete(spark, f"{root}/state/route-checkpoint/commits")  # the last batches are run again
    state.advance(landing)
    assert state.late.read().count() == before
    assert _rows(state.current(), sorted(log.columns)) == _rows(latest_as_of(log, S.PURCHASE_KEY), sorted(log.columns))
