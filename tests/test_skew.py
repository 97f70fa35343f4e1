"""Skew: one entity holding a third of all versions, one purchase holding a
third of all items (both derived from the sf0.001 logs). Results must stay
exact (brute force) and the hot key must be trimmed before its shuffle."""

from __future__ import annotations

from pyspark.sql import functions as F

from tempora import schemas as S
from tempora.functions.rules import RunParams
from tempora.operators.gmv import gmv_snapshot
from test_bruteforce import _snapshot

RUN = RunParams.for_day("1998-06-30")
HOT = (1, 199501)


def _skewed(logs):
    hot_p = F.col("purchase_id") % 3 == 0
    # A third of the purchase versions become versions of ONE purchase; the
    # order key in microseconds keeps every (event_ts, ingestion_ts) distinct.
    p = logs[S.PURCHASE].select(
        *[F.when(hot_p, F.lit(HOT[0]).cast("long")).otherwise(F.col("purchase_id")).alias("purchase_id")
          if c == "purchase_id" else
          F.when(hot_p, F.lit(HOT[1]).cast("long")).otherwise(F.col("purchase_partition")).alias("purchase_partition")
          if c == "purchase_partition" else
          F.when(hot_p, F.col("event_ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                               F.col("purchase_id") / F.lit(1_000_000)))
           .otherwise(F.col("event_ts")).alias("event_ts")
          if c == "event_ts" else F.col(c)
          for c in logs[S.PURCHASE].columns])
    # A third of the items point to the hot purchase.
    hot_i = F.col("prod_item_id") % 3 == 0
    i = (logs[S.ITEM]
         .withColumn("purchase_id", F.when(hot_i, F.lit(HOT[0]).cast("long")).otherwise(F.col("purchase_id")))
         .withColumn("purchase_partition",
                     F.when(hot_i, F.lit(HOT[1]).cast("long")).otherwise(F.col("purchase_partition"))))
    return {**logs, S.PURCHASE: p, S.ITEM: i}


def test_hot_keys_stay_exact(small_logs):
    skewed = _skewed(small_logs)
    hot_versions = skewed[S.PURCHASE].where(F.col("purchase_id") == HOT[0]).count()
    assert hot_versions * 3 >= skewed[S.PURCHASE].count() * 0.9
    rows = {t: [r.asDict() for r in df.collect()] for t, df in skewed.items()}
    got = sorted(tuple(r) for r in gmv_snapshot(skewed, RUN).collect())
    assert got == _snapshot(rows, RUN)


def test_hot_key_is_trimmed_before_the_shuffle(small_logs):
    plan = gmv_snapshot(_skewed(small_logs), RUN)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 6          # partial + final for each of the three picks
    assert "partial_sum" in plan and "partial_max" in plan   # item sum per purchase combined map-side
