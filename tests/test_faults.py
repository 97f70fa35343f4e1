"""Deliveries that break a rule, arrive late or come under another delete rule."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tempora import schemas as S
from tempora.__main__ import main
from tempora.plans import jobs
from tempora.session import scratch_path
from tempora.sinks.gold import GoldTable, SnapshotError
from tempora.sinks.raw import DeliveryError, read_raw
from tempora.streaming.ingest import land, start_bronze
from tempora.streaming.snapshots import emit_due_snapshots, incomplete_runs

DAYS = ("2023-01-07", "2023-01-10", "2023-01-20")


def _stores(spark, mock, name):
    root = scratch_path(spark, name)
    for t, df in mock.items():
        jobs.ingest(spark, df, os.path.join(root, "raw"), t)
    return os.path.join(root, "raw"), os.path.join(root, "gold")


def _rows(df):
    return sorted(tuple(map(str, r)) for r in df.drop("run_id").collect())


def _late_item(mock):
    """A second item of the first mock purchase, stamped before run 1's cutoff."""
    one = mock[S.ITEM].where("op <> 'd'").orderBy("purchase_id").limit(1)
    return one.withColumn("prod_item_id", F.lit(987).cast("long")).withColumn("purchase_value", F.lit(900).cast("decimal(18,2)")).withColumn(
        "item_quantity", F.lit(1)).withColumn("ingestion_ts", F.lit("2023-01-07 23:00:00").cast("timestamp_ntz"))


@pytest.mark.parametrize("day", DAYS[1:])
def test_incremental_sees_what_was_delivered_late(spark, mock, day):
    raw, gold = _stores(spark, mock, "fault-late")
    jobs.daily_snapshot(spark, raw, gold, DAYS[0])
    jobs.ingest(spark, _late_item(mock), raw, S.ITEM)
    jobs.daily_snapshot(spark, raw, gold, day)
    jobs.daily_snapshot(spark, raw, gold + "-full", day, mode="full")
    got, want = (_rows(GoldTable(spark, g).as_of(day)) for g in (gold, gold + "-full"))
    assert got == want


@pytest.mark.parametrize("mode", ["auto", "full"])
def test_a_day_that_is_null_is_refused_by_every_mode(spark, mock, mode):
    raw, gold = _stores(spark, mock, "fault-null")
    jobs.daily_snapshot(spark, raw, gold, DAYS[0])
    stamp = F.lit("2023-01-09 10:00:00").cast("timestamp_ntz")
    key = {"purchase_id": F.lit(555).cast("long"), "event_ts": stamp, "ingestion_ts": stamp, "op": F.lit("c")}
    one = mock[S.PURCHASE].where("release_date IS NOT NULL").limit(1).withColumns(key).withColumns(
        {"order_date": F.lit(None).cast("date"), "purchase_status": F.lit(None).cast("string")})
    jobs.ingest(spark, one, raw, S.PURCHASE)
    jobs.ingest(spark, mock[S.EXTRA].limit(1).withColumns(key), raw, S.EXTRA)
    part = one.first()["purchase_partition"]
    jobs.ingest(spark, mock[S.ITEM].limit(1).withColumns({**key, "purchase_partition": F.lit(part).cast("long"), "prod_item_id": F.lit(5).cast("long")}), raw, S.ITEM)
    extra = mock[S.EXTRA].limit(1).withColumns({**key, "purchase_partition": F.lit(part).cast("long")})
    jobs.ingest(spark, extra, raw, S.EXTRA, quarantine=os.path.join(raw, "q"))
    with pytest.raises(SnapshotError):
        jobs.daily_snapshot(spark, raw, gold, DAYS[1], mode=mode)


def test_no_carrying_forward_across_delete_rules(spark, mock):
    raw, gold = _stores(spark, mock, "fault-deletes")
    jobs.daily_snapshot(spark, raw, gold, DAYS[0], mode="full", honor_deletes=True)
    with pytest.raises(ValueError):
        jobs.daily_snapshot(spark, raw, gold, DAYS[1], mode="incremental")
    jobs.daily_snapshot(spark, raw, gold, DAYS[1])
    jobs.daily_snapshot(spark, raw, gold + "-full", DAYS[1], mode="full")
    assert _rows(GoldTable(spark, gold).as_of(DAYS[1])) == _rows(GoldTable(spark, gold + "-full").as_of(DAYS[1]))


def test_bad_rows_are_refused_or_quarantined(spark, mock):
    root = scratch_path(spark, "fault-bad")
    cost = mock[S.COST]
    bad = cost.limit(1).withColumn("op", F.lit("x"))
    with pytest.raises(DeliveryError):
        jobs.ingest(spark, cost.unionByName(bad), root, S.COST)
    quarantine = os.path.join(root, "quarantine")
    for _ in range(2):  # a repeated delivery changes neither store nor quarantine
        done = jobs.ingest(spark, cost.unionByName(bad), root, S.COST, quarantine)
        assert done["rejected"] == 1
    assert spark.read.parquet(quarantine).count() == 1
    assert read_raw(spark, os.path.join(root, S.COST), S.COST).count() == cost.count()
    assert jobs.ingest(spark, cost, root, S.COST) | {"path": ""} == {"path": "", "accepted": 0, "rejected": 0, "accepted_until": done["accepted_until"]}


def test_conflicting_keys_are_refused(spark, mock):
    root = scratch_path(spark, "fault-conflict")
    cost = mock[S.COST]
    other = cost.limit(1).withColumn("order_transaction_cost_vat_value", F.lit(99).cast("decimal(18,2)"))
    with pytest.raises(DeliveryError):  # inside one delivery: neither copy is stored
        jobs.ingest(spark, cost.unionByName(other), root, S.COST)
    jobs.ingest(spark, cost, root, S.COST)
    with pytest.raises(DeliveryError):  # against the store
        jobs.ingest(spark, other, root, S.COST)
    assert jobs.ingest(spark, other, root, S.COST, os.path.join(root, "q"))["rejected"] == 1
    assert read_raw(spark, os.path.join(root, S.COST), S.COST).count() == cost.count()


def test_stream_waits_for_accepted_rows(spark, mock):
    root = scratch_path(spark, "fault-stream")
    gold = GoldTable(spark, os.path.join(root, "gold"))
    cut = F.lit("2023-01-08").cast("timestamp_ntz")

    def deliver(logs):
        for t, df in logs.items():
            landing = os.path.join(root, "landing", t)
            land(df, landing)
            start_bronze(spark, landing, os.path.join(root, "bronze", t), os.path.join(root, "ckpt", t), t,
                         quarantine=os.path.join(root, "quarantine", t)).awaitTermination()
        return [r.as_of_date.isoformat() for r in emit_due_snapshots(spark, os.path.join(root, "bronze"), gold, DAYS[:2])]

    logs = {t: mock[t] for t in jobs.SNAPSHOT_LOGS}
    future = F.lit("2099-01-01").cast("timestamp_ntz")
    bad = {t: df.limit(1).withColumns({"op": F.lit("x"), "ingestion_ts": future, "event_ts": future}) for t, df in logs.items()}
    assert deliver({t: df.where(F.col("ingestion_ts") < cut).unionByName(bad[t]) for t, df in logs.items()}) == []
    later = F.lit("2023-02-01").cast("timestamp_ntz")  # a sound row of another purchase closes the days
    mark = {t: df.where("op <> 'd'").limit(1).withColumns({c: F.lit(70000).cast("long") for c in S.ENTITY_KEYS[t][:1]} | {
        "ingestion_ts": later, "event_ts": later}) for t, df in logs.items()}
    assert deliver({t: df.where(F.col("ingestion_ts") >= cut).unionByName(mark[t]) for t, df in logs.items()}) == list(DAYS[:2])
    full = os.path.join(root, "full")
    jobs.daily_snapshot(spark, os.path.join(root, "bronze"), full, DAYS[1], mode="full")
    assert _rows(gold.as_of(DAYS[1])) == _rows(GoldTable(spark, full).as_of(DAYS[1]))
    assert incomplete_runs(spark, os.path.join(root, "bronze"), gold).count() == 0
    deliver({S.ITEM: _late_item(mock)})
    late = {(r.as_of_date.isoformat(), r.log): r.late_events for r in incomplete_runs(spark, os.path.join(root, "bronze"), gold).collect()}
    assert late == {(d, S.ITEM): 1 for d in DAYS[:2]}


def test_reports_are_written_whole(spark, mock, capsys):
    raw, gold = _stores(spark, mock, "fault-report")
    jobs.daily_snapshot(spark, raw, gold, DAYS[1])
    out = os.path.join(raw, "report")
    assert main(["report", "--gold", gold, "--whole", "--output", out, "--show", "1"]) == 0
    got = spark.read.parquet(out)
    assert got.columns == S.GOLD_COLUMNS and got.count() == GoldTable(spark, gold).current().count() > 1


def test_lateness_is_a_timedelta():
    from tempora.streaming.snapshots import due_days

    assert due_days(["2023-01-07"], dt.datetime(2023, 1, 7, 23), set()) == []
    assert len(due_days(["2023-01-07"], dt.datetime(2023, 1, 8), set())) == 1
