"""Rows cross the network once per append and once per merge into silver, and not at all for the bucketed tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tempora import schemas as S
from tempora.functions.rules import RunParams
from tempora.operators import gmv, quality
from tempora.operators.gmv import gmv_snapshot
from tempora.plans import jobs
from tempora.session import scratch_path
from tempora.sinks import raw, silver
from tempora.sinks.gold import GoldTable
from tempora.sources import testdata as TD

SF = "/root/testdata/sf0.001"
KEY = S.RAW_KEYS[S.PURCHASE]


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange rangepartitioning"), plan.count("Exchange hashpartitioning") + plan.count("Exchange Round")


@pytest.fixture(scope="module")
def log(spark):
    return TD.purchase_cdc(spark, SF, derived=True).checkpoint()


@pytest.mark.parametrize("own_day", [True, False])
@pytest.mark.parametrize("copies", [True, False])
def test_a_delivery_is_judged_in_one_exchange(spark, log, copies, own_day):
    stored = log.where("purchase_id % 3 = 0")
    changed = log.withColumn("purchase_status", F.when(F.col("purchase_id") % 5 == 0, "?").otherwise(F.col("purchase_status")))
    within = log.where("purchase_id % 7 = 1").withColumn("buyer_id", F.lit(-1).cast("long"))
    batch = changed.unionByName(changed).unionByName(within).checkpoint()
    got = quality.judged(batch, stored, S.PURCHASE, copies, own_day)
    assert exchanges(got) == (1, int(copies)) and exchanges(quality.judged(batch, None, S.PURCHASE)) == (1, 0)
    clash = (F.col("purchase_id") % 7 == 1) | ((F.col("purchase_id") % 15 == 0))
    assert rows(got.where("clash").select(*KEY)) == rows(log.where(clash).select(*KEY))
    assert rows(got.where("NOT clash").drop("clash")) == rows(changed.where(~clash & (F.col("purchase_id") % 3 != 0)))


def test_a_merge_gathers_once(spark):
    for table in silver.SILVER_LOGS:
        events = TD.DERIVERS[table](spark, SF).checkpoint()
        once = silver.winning_days(silver.gathered(events, table), table)
        assert exchanges(once) == (1, 0)
        assert rows(once) == rows(silver.winning_days(events, table))
        crowd = events.unionByName(events).unionByName(events)
        assert rows(silver.winning_days(silver.gathered(silver.best_of_days(crowd, table), table), table)) == rows(once)


def test_crowded_days_are_told(spark, log):
    store = silver.SilverStore(spark, scratch_path(spark, "crowded"))
    hot = log.withColumn("purchase_id", F.when(F.col("purchase_id") % 3 == 0, 1).otherwise(F.col("purchase_id")).cast("long")).withColumn("purchase_partition", F.lit(7).cast("long"))
    same_day = hot.withColumn("ingestion_ts", F.when(F.col("purchase_id") == 1, F.lit("1998-01-01").cast("timestamp_ntz")).otherwise(F.col("ingestion_ts")))
    assert store._touched(log, S.PURCHASE)[1] is False and store._touched(same_day, S.PURCHASE) == ([7], True)


@pytest.mark.parametrize("spread", [64, 2])
def test_buckets_follow_the_rows(spark, small_logs, monkeypatch, spread):
    monkeypatch.setattr(silver, "BUCKET_ROWS", 500)
    monkeypatch.setattr(silver, "SPREAD_BUCKETS", spread)
    root = scratch_path(spark, "bucketed-raw")
    for t in jobs.SNAPSHOT_LOGS:
        raw.append_raw(spark, TD.DERIVERS[t](spark, SF), raw.raw_path(root, t), t)
    store = jobs.silver_store(spark, root)
    store.refresh(root)
    most = max(store.tables[t].read().count() for t in silver.SILVER_LOGS)
    names = store.publish_bucketed(f"silver_rows_{spread}")
    described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {names[S.ITEM]}").collect()}
    assert int(described["Num Buckets"]) == -(-most // 500) > silver.MIN_BUCKETS
    run = RunParams.for_day("1998-07-31")
    got = gmv.snapshot_from_states(*[silver.known_on(spark.table(names[t]), run.as_of_date) for t in (S.PURCHASE, S.EXTRA, S.ITEM)], run)
    assert rows(got) == rows(gmv_snapshot(small_logs, run))


def test_the_first_run_makes_silver_and_reads_its_states(spark, small_logs):
    root = scratch_path(spark, "first-run")
    for t in jobs.SNAPSHOT_LOGS:
        jobs.ingest(spark, TD.DERIVERS[t](spark, SF), f"{root}/raw", t)
    for day in ("1998-06-30", "1998-07-31"):
        assert jobs.daily_snapshot(spark, f"{root}/raw", f"{root}/gold", day)
        assert rows(GoldTable(spark, f"{root}/gold").current()) == rows(gmv_snapshot(small_logs, RunParams.for_day(day)))
        assert [jobs.silver_store(spark, f"{root}/raw").covered(t) for t in jobs.SNAPSHOT_LOGS] == [1, 1, 1]


def test_copies_of_item_events_are_stored_once(spark):
    path = scratch_path(spark, "item-copies")
    items = TD.item_cdc(spark, SF, distinct=False)
    raw.append_raw(spark, items.unionByName(items).unionByName(items), path, S.ITEM)
    assert rows(raw.read_raw(spark, path, S.ITEM).drop("transaction_date")) == rows(TD.item_cdc(spark, SF))
