"""Properties on the derived test logs (sf0.001): order, replays, incremental,
streaming and comparison invariants."""

from __future__ import annotations

from pyspark.sql import functions as F

from tempora import schemas as S
from tempora.functions.rules import RunParams
from tempora.operators import compare, incremental, quality
from tempora.operators.gmv import gmv_snapshot, multi_snapshot
from tempora.operators.latest import latest_as_of
from tempora.session import scratch_path
from tempora.sinks.raw import append_raw, read_raw
from tempora.sources import testdata as TD

SF = "/root/testdata/sf0.001"
R1, R2, R3 = (RunParams.for_day(d) for d in ("1998-06-30", "1998-07-31", "1998-08-01"))


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def test_fixture_row_counts(spark):
    assert TD.purchase_cdc(spark, SF).count() == 2056
    assert TD.extra_cdc(spark, SF).count() == 1684
    assert TD.item_cdc(spark, SF).count() == 6000
    assert TD.cost_cdc(spark, SF).count() == 1632


def test_snapshot_sizes(small_logs):
    assert gmv_snapshot(small_logs, R1).count() == 436
    assert gmv_snapshot(small_logs, R2).count() == 446
    assert gmv_snapshot(small_logs, RunParams.for_day("2001-12-31")).count() == 877


def test_input_order_does_not_matter(small_logs):
    shuffled = {t: df.orderBy(F.rand(7)).repartition(5) for t, df in small_logs.items()}
    assert _set(gmv_snapshot(shuffled, R1)) == _set(gmv_snapshot(small_logs, R1))


def test_replaying_events_changes_nothing(small_logs):
    replayed = {t: df.unionByName(df.where(F.col("ingestion_ts") < F.lit("1998-05-01").cast("timestamp_ntz")))
                for t, df in small_logs.items()}
    assert _set(gmv_snapshot(replayed, R1)) == _set(gmv_snapshot(small_logs, R1))


def test_multi_equals_union_of_single_runs(small_logs):
    single = gmv_snapshot(small_logs, R1).unionByName(gmv_snapshot(small_logs, R2))
    assert _set(multi_snapshot(small_logs, [R1, R2])) == _set(single)


def test_incremental_equals_full(small_logs):
    for prev, new in ((R1, R2), (R2, R3), (R1, RunParams.for_day("1999-12-31"))):
        inc = incremental.incremental_snapshot(small_logs, gmv_snapshot(small_logs, prev), prev, new)
        assert _set(inc) == _set(gmv_snapshot(small_logs, new)), (prev, new)


def test_diff_plus_old_is_new(small_logs):
    a, b = gmv_snapshot(small_logs, R1), gmv_snapshot(small_logs, R2)
    d = compare.snapshot_diff(a, b)
    rebuilt = (d.where(F.col("change") != "vanished")
               .select("transaction_date", "subsidiary",
                       (F.coalesce("old_gmv", F.lit(0)) + F.col("delta_gmv")).cast(S.MONEY).alias("gmv_amount")))
    assert _set(rebuilt) == _set(b.select("transaction_date", "subsidiary", "gmv_amount"))


def test_quality_split_is_a_partition(spark):
    dirty = TD.dirty_purchase_cdc(spark, SF)
    acc, rej = quality.split(dirty, S.PURCHASE)
    assert acc.count() + rej.count() == dirty.count()
    assert rej.where(F.col("reject_reason").isNull()).count() == 0


def test_raw_append_replay_is_noop(spark):
    path = scratch_path(spark, "test-raw")
    log = TD.purchase_cdc(spark, SF)
    append_raw(spark, log, path, S.PURCHASE)
    append_raw(spark, TD.replayed_purchase_cdc(spark, SF), path, S.PURCHASE)
    stored = read_raw(spark, path, S.PURCHASE)
    assert stored.count() == log.count()
    assert quality.duplicate_keys(stored, S.PURCHASE).count() == 0


def test_stale_late_event_never_wins(spark):
    """k % 13 = 0 sends an APROVADA with an older event time, arriving last."""
    p = latest_as_of(TD.purchase_cdc(spark, SF), S.PURCHASE_KEY, "2002-01-01 00:00:00")
    stale = p.where((F.col("purchase_id") % 13 == 0) & (F.col("purchase_id") % 10 == 2))
    assert stale.count() > 0
    assert stale.where(F.col("purchase_status") != "REEMBOLSADA").where(F.col("purchase_status") != "CANCELADA").count() == 0


def test_honor_deletes_option(small_logs):
    """Default keeps deleted extra info (reference rule); the option drops it."""
    default = gmv_snapshot(small_logs, R2)
    strict = gmv_snapshot(small_logs, R2, honor_deletes=True)
    total = lambda df: df.agg(F.sum("purchases_count")).first()[0]
    assert total(strict) < total(default)
