"""Registered streaming queries (run with ``availableNow``, then read back).

Deliveries are simulated by dropping the derived RAW log into a landing
folder in three parts split at the run cutoffs (plus a replay of some
events), with the stream restarted from its checkpoint after each drop.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora import schemas as S
from tempora.functions.rules import ts_lit
from tempora.plans.queries import RUN1, RUN2
from tempora.session import scratch_path
from tempora.sinks.gold import GoldTable
from tempora.sinks.raw import read_raw
from tempora.sources import testdata as TD
from tempora.streaming.ingest import land, start_bronze
from tempora.streaming.snapshots import emit_due_snapshots
from tempora.streaming.state import StateStream

CUTOFFS = (RUN1.cutoff_ts, RUN2.cutoff_ts)


def _drops(log: DataFrame) -> list[DataFrame]:
    """Three deliveries split at the run cutoffs, each in arrival order."""
    a, b = (ts_lit(c) for c in CUTOFFS)
    ing = F.col("ingestion_ts")
    return [log.where(ing < a), log.where((ing >= a) & (ing < b)), log.where(ing >= b)]


def _replay(log: DataFrame) -> DataFrame:
    return log.where(F.col("purchase_id") % 5 == 0)


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty purchase log delivered in three drops (the last one replays
    earlier events): bronze holds the accepted events once each."""
    root = scratch_path(spark, "stream-bronze")
    landing, bronze = os.path.join(root, "landing"), os.path.join(root, "bronze")
    log = TD.dirty_purchase_cdc(spark, sf_dir)
    drops = _drops(log)
    drops[2] = drops[2].unionByName(_replay(drops[0]))
    for d in drops:
        land(d, landing)
        start_bronze(spark, landing, bronze, os.path.join(root, "ckpt"), S.PURCHASE,
                     quarantine=os.path.join(root, "quarantine")).awaitTermination()
    return read_raw(spark, bronze, S.PURCHASE)


def stream_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest purchase state kept by the stream, open days included; equals the batch pick over all events."""
    root = scratch_path(spark, "stream-state")
    landing, state = os.path.join(root, "landing"), StateStream(spark, S.PURCHASE, os.path.join(root, "state"))
    drops = _drops(TD.purchase_cdc(spark, sf_dir))
    drops[1] = drops[1].unionByName(_replay(drops[0]))  # behind the watermark
    for d in drops:
        land(d, landing)
        state.advance(landing)
    return state.current()


def stream_state_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase state as of run 1 kept by the stream, read after all drops (run 2's state starts from it)."""
    root = scratch_path(spark, "stream-as-of")
    landing, state = os.path.join(root, "landing"), StateStream(spark, S.PURCHASE, os.path.join(root, "state"))
    for d in _drops(TD.purchase_cdc(spark, sf_dir)):
        land(d, landing)
        state.advance(landing)
        state.emit_due([RUN1.as_of_date, RUN2.as_of_date])
    return state.as_of(RUN1.as_of_date)


def stream_daily_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three logs streamed to bronze; snapshots of run 1 and run 2 emitted as
    soon as arrivals pass their cutoffs; returns the GOLD history."""
    root = scratch_path(spark, "stream-gold")
    gold = GoldTable(spark, os.path.join(root, "gold"))
    logs = {S.PURCHASE: TD.purchase_cdc(spark, sf_dir), S.EXTRA: TD.extra_cdc(spark, sf_dir),
            S.ITEM: TD.item_cdc(spark, sf_dir, distinct=False)}  # bronze keeps one of exact copies
    drops = {t: _drops(df) for t, df in logs.items()}
    schedule = [RUN1.as_of_date, RUN2.as_of_date]
    for n in range(3):
        for t in logs:
            landing = os.path.join(root, "landing", t)
            land(drops[t][n], landing)
            start_bronze(spark, landing, os.path.join(root, "bronze", t), os.path.join(root, "ckpt", t), t,
                         quarantine=os.path.join(root, "quarantine", t)).awaitTermination()
        emit_due_snapshots(spark, os.path.join(root, "bronze"), gold, schedule)
    return gold.history()


STREAM_QUERIES = {
    "stream_bronze": stream_bronze,
    "stream_latest_state": stream_latest_state,
    "stream_state_as_of": stream_state_as_of,
    "stream_daily_snapshot": stream_daily_snapshot,
}
