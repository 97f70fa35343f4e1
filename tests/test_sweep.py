"""Many cutoffs in one job: aligned spans, and rows that follow the changes of a hot purchase."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tempora import schemas as S
from tempora.functions.rules import RunParams
from tempora.operators import gmv
from test_skew import _skewed

HOT = (1, 199501)


@pytest.mark.parametrize("runs", [1, 2, 3, 8, 13])
def test_spans_cover_each_run_once(spark, runs):
    pairs = [(a, b) for a in range(runs) for b in range(a, runs)]
    df = spark.createDataFrame(pairs, "a int, b int").withColumn("spans", gmv._spans(F.col("a"), F.col("b"), runs))
    over = {r.id: set(r.s) for r in spark.range(runs).select("id", gmv._spans_over(F.col("id").cast("int"), runs).alias("s")).collect()}
    for a, b, spans in df.collect():
        assert len(set(spans)) == len(spans) <= 2 * len(gmv._levels(runs))
        for run in range(runs):
            assert len(over[run] & set(spans)) == (1 if a <= run <= b else 0), (a, b, run)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_a_hot_purchase_over_many_runs(spark, small_logs):
    logs = _skewed(small_logs)
    runs = [RunParams.for_day(dt.date(1998, 1, 1) + dt.timedelta(days=7 * n)) for n in range(40)]
    got = gmv.multi_snapshot(logs, runs).cache()
    for r in (runs[0], runs[13], runs[39]):
        assert _rows(got.where(F.col("as_of_date") == F.lit(r.as_of_date))) == _rows(gmv.gmv_snapshot(logs, r))
    got.unpersist()


def test_rows_follow_changes_not_runs_times_items(spark, small_logs):
    """A purchase with 3,000 items, a third of all, that come one by one: a segment per run, a step per run, not their product."""
    logs = dict(small_logs)
    first = dt.datetime(1998, 1, 1)
    one = logs[S.ITEM].where("op <> 'd'").limit(1).drop("prod_item_id", "event_ts", "ingestion_ts")
    at = F.lit(first.isoformat(sep=" ")).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id") * 3)
    items = spark.range(3000).crossJoin(F.broadcast(one)).withColumns({
        "prod_item_id": F.col("id") + 10_000_000, "event_ts": at, "ingestion_ts": at, "purchase_id": F.lit(HOT[0]).cast("long"),
        "purchase_partition": F.lit(HOT[1]).cast("long")})
    gone = items.where("id % 10 = 0").withColumns({"op": F.lit("d"), "event_ts": at + F.expr("INTERVAL 50 DAYS"), "ingestion_ts": at + F.expr("INTERVAL 50 DAYS")})
    logs[S.ITEM] = logs[S.ITEM].unionByName(items.select(*logs[S.ITEM].columns)).unionByName(gone.select(*logs[S.ITEM].columns))
    purchase = logs[S.PURCHASE].where("release_date IS NOT NULL AND op <> 'd'").limit(1)
    early = {c: F.lit("1997-01-01").cast("timestamp_ntz") for c in ("event_ts", "ingestion_ts")}
    key = {"purchase_id": F.lit(HOT[0]).cast("long"), "purchase_partition": F.lit(HOT[1]).cast("long")}
    logs[S.PURCHASE] = logs[S.PURCHASE].where("purchase_id <> 1").unionByName(purchase.withColumns({**key, **early, "purchase_status": F.lit(None).cast("string")}))
    logs[S.EXTRA] = logs[S.EXTRA].where("purchase_id <> 1").unionByName(logs[S.EXTRA].limit(1).withColumns({**key, **early}))
    runs = [RunParams.for_day(first.date() + dt.timedelta(days=n)) for n in range(365)]
    hot = {t: (df if t == S.ITEM else df.where("purchase_id = 1")) for t, df in logs.items()}
    segs = gmv.eligible_intervals({**hot, S.ITEM: hot[S.ITEM].where("purchase_id = 1")}, runs).cache()
    assert 300 < segs.count() <= 366
    got = gmv.multi_snapshot(logs, runs)
    for r in (runs[0], runs[77], runs[364]):
        assert _rows(got.where(F.col("as_of_date") == F.lit(r.as_of_date))) == _rows(gmv.gmv_snapshot(logs, r))
    segs.unpersist()
