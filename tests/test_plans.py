"""Physical-plan checks: pushdown, top-1 trimming before the shuffle, and
no extra exchange for the joins on the purchase key."""

from __future__ import annotations

import pytest

from tempora import schemas as S
from tempora.functions.rules import RunParams
from tempora.operators.gmv import gmv_snapshot
from tempora.operators.latest import latest_as_of
from tempora.session import scratch_path
from tempora.sinks.raw import read_raw, write_raw
from tempora.sources import testdata as TD

RUN = RunParams.for_day("1998-06-30")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def stored_purchase(spark):
    path = scratch_path(spark, "test-plan-raw")
    write_raw(TD.purchase_cdc(spark, "/root/testdata/sf0.001", derived=True), path)
    return read_raw(spark, path, S.PURCHASE, with_partition=True)


def test_cutoff_is_pushed_to_the_scan(spark, stored_purchase):
    df = latest_as_of(stored_purchase, S.PURCHASE_KEY, RUN.cutoff_ts, ["order_date"])
    plan = _formatted(df)
    assert "LessThan(ingestion_ts,1998-07-01T00:00)" in plan
    assert "ingest_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # column pruning: payload columns not asked for are not read
    read_schema = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "purchase_total_value" not in read_schema and "buyer_id" not in read_schema


def test_top1_is_trimmed_before_the_shuffle(spark, stored_purchase):
    df = latest_as_of(stored_purchase, S.PURCHASE_KEY, RUN.cutoff_ts)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan


def test_snapshot_exchange_budget(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        logs = TD.cdc_logs(spark, "/root/testdata/sf0.001")
        plan = _plan(gmv_snapshot(logs, RUN))
        # Core budget: purchase pick, extra pick and item sum on the purchase
        # key; item pick on the item key; the final (day, subsidiary) aggregate.
        # The two joins on the purchase key reuse that partitioning. (The
        # fixture's own joins that derive the logs add exchanges of their own.)
        assert plan.count("Exchange hashpartitioning(purchase_id") == 3, plan
        assert plan.count("Exchange hashpartitioning(prod_item_id") == 1, plan
        assert plan.count("Exchange hashpartitioning(transaction_date") == 1, plan
        assert "SortMergeJoin [purchase_id" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_margin_left_join_reuses_partitioning(spark):
    from tempora.operators.margin import contribution_margin

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        logs = TD.cdc_logs(spark, "/root/testdata/sf0.001")
        plan = _plan(contribution_margin(logs, RUN.cutoff_ts, ordered=False))
        # purchase, extra and cost picks plus the item sum: 4 on the purchase key;
        # the inner joins and the cost LEFT join add none.
        assert plan.count("Exchange hashpartitioning(purchase_id") == 4, plan
        assert "SortMergeJoin [purchase_id#" in plan and "LeftOuter" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_multi_snapshot_shuffles_changes_not_runs(spark):
    from tempora.operators.gmv import multi_snapshot

    logs = TD.cdc_logs(spark, "/root/testdata/sf0.001")
    runs = [RunParams.for_day(d) for d in ("1998-06-30", "1998-07-31", "2001-12-31")]
    plan = multi_snapshot(logs, runs)._jdf.queryExecution().sparkPlan().toString()
    # the best version per key and bucket is trimmed before its shuffle, and nothing sorts a log to aggregate it
    assert plan.count("WindowGroupLimit") >= 6 and "Partial" in plan and "SortAggregate" not in plan
    # runs are spread out only above the (day, subsidiary, interval) totals
    top = plan.index("Generate explode(sequence(")
    assert "functions=[sum(gmv_amount" in plan[:top] and plan.count("explode(sequence(") == 1


def test_append_reads_only_the_months_of_the_delivery(spark, stored_purchase):
    from tempora.operators import quality
    from tempora.sinks.raw import in_months, months_of

    batch = TD.purchase_cdc(spark, "/root/testdata/sf0.001", derived=True).where("transaction_date between '1998-06-03' and '1998-06-20'")
    plan = _formatted(quality.not_stored_yet(batch, in_months(stored_purchase, months_of(batch)), S.PURCHASE))
    assert "ingest_month" in plan.split("PartitionFilters: [")[1].split("]")[0] and "= 1998-06-01)" in plan


def test_rerun_guard_reads_only_its_dates(spark):
    from tempora.operators.gmv import gmv_snapshot
    from tempora.sinks.gold import GoldTable

    g = GoldTable(spark, scratch_path(spark, "test-guard-plan"))
    snap = gmv_snapshot(TD.cdc_logs(spark, "/root/testdata/sf0.001"), RUN)
    g.append(snap)
    plan = _formatted(g.collisions(snap, [RUN.as_of_date, "1998-07-01"]))
    assert "as_of_date" in plan.split("PartitionFilters: [")[1].split("]")[0] and "1998-07-01" in plan
