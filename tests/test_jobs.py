"""The daily workflow on stored tables, end to end on the mock scenario."""

from __future__ import annotations

import os

from mock_rows import GOLDEN_SNAPSHOTS
from tempora import schemas as S
from tempora.__main__ import main
from tempora.plans import jobs
from tempora.session import scratch_path
from tempora.sinks.gold import GoldTable


def _gold_rows(df):
    return sorted(
        (r.as_of_date.isoformat(), r.transaction_date.isoformat(), r.subsidiary, str(r.gmv_amount),
         r.purchases_count, r.source_max_ingestion_ts.isoformat(sep=" "), r.run_id)
        for r in df.collect())


def test_daily_workflow(spark, mock, capsys):
    root = scratch_path(spark, "test-jobs")
    raw, gold = os.path.join(root, "raw"), os.path.join(root, "gold")
    for t, df in mock.items():
        jobs.ingest(spark, df, raw, t)
        jobs.ingest(spark, df, raw, t)  # a replayed delivery changes nothing
    assert jobs.raw_logs(spark, raw)[S.PURCHASE].count() == 5

    assert jobs.daily_snapshot(spark, raw, gold, "2023-01-07") is True          # full
    assert jobs.daily_snapshot(spark, raw, gold, "2023-01-10") is True          # incremental
    assert jobs.daily_snapshot(spark, raw, gold, "2023-01-10") is False         # already stored
    assert _gold_rows(GoldTable(spark, gold).history()) == sorted(GOLDEN_SNAPSHOTS)

    cur = [(r.transaction_date.isoformat(), r.subsidiary, str(r.gmv_amount))
           for r in jobs.current_report(spark, gold).collect()]
    assert cur == [("2023-01-06", "S1", "100.00"), ("2023-01-06", "S2", "150.00")]
    m = [(r.subsidiary, str(r.contribution_margin)) for r in jobs.margin_report(spark, raw, "2023-01-10").collect()]
    assert m == [("S1", "97.00"), ("S2", "146.00")]

    assert main(["report", "--gold", gold, "--as-of", "2023-01-07"]) == 0
    out = capsys.readouterr().out
    assert "2023-01-05" in out and "200.00" in out


def test_backfill_one_job(spark, mock):
    root = scratch_path(spark, "test-backfill")
    raw, gold = os.path.join(root, "raw"), os.path.join(root, "gold")
    for t, df in mock.items():
        jobs.ingest(spark, df, raw, t)
    jobs.daily_snapshot(spark, raw, gold, "2023-01-07")
    written = jobs.backfill(spark, raw, gold, "2023-01-07", "2023-01-10")
    assert [d.isoformat() for d in written] == ["2023-01-08", "2023-01-09", "2023-01-10"]
    assert jobs.backfill(spark, raw, gold, "2023-01-07", "2023-01-10") == []
    hist = _gold_rows(GoldTable(spark, gold).history())
    assert [r for r in hist if r[0] in ("2023-01-07", "2023-01-10")] == sorted(GOLDEN_SNAPSHOTS)
    # nothing arrived between the 8th and the 10th midnight: same rows as the 7th
    seventh = [r[1:6] for r in hist if r[0] == "2023-01-07"]
    assert [r[1:6] for r in hist if r[0] == "2023-01-09"] == seventh


def test_cli_ingest_delivery_folder(spark, mock):
    root = scratch_path(spark, "test-cli")
    delivery, raw = os.path.join(root, "delivery"), os.path.join(root, "raw")
    mock[S.PURCHASE].write.parquet(delivery)
    assert main(["ingest", "--raw", raw, "--table", S.PURCHASE, "--input", delivery]) == 0
    assert main(["ingest", "--raw", raw, "--table", S.PURCHASE, "--input", delivery]) == 0  # re-delivery
    stored = jobs.raw_logs(spark, raw, (S.PURCHASE,))[S.PURCHASE]
    assert stored.count() == 5
    assert stored.where("transaction_date IS NULL").count() == 0
