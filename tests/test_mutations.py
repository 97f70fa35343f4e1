"""Negative tests: wrong readings of the rules must change the sf0.001 result.

Each mutant rebuilds the snapshot with one rule read the wrong way; the
fixtures must be strong enough to tell it from the right answer.
"""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tempora import schemas as S
from tempora.functions.rules import RunParams, item_amount, purchase_eligible, ts_lit
from tempora.operators import gmv
from tempora.operators.latest import latest_as_of

RUN = RunParams.for_day("1998-06-30")
PK = S.PURCHASE_KEY


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _snapshot(p, e, i):
    return gmv.aggregate_snapshot(gmv.eligible_purchases(p, e, gmv.items_by_purchase(i)))


def _silver(logs, cutoff=RUN.cutoff_ts):
    s = gmv.silver(logs, cutoff)
    return s["purchase"], s["extra"], s["item"]


def _pick(df, keys, order):
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def test_right_answer_baseline(small_logs):
    assert _rows(_snapshot(*_silver(small_logs))) == _rows(gmv.aggregate_snapshot(gmv.eligible_at(small_logs, RUN.cutoff_ts)))


def _mutant(logs, name):
    cut = ts_lit(RUN.cutoff_ts)
    p, e, i = _silver(logs)
    if name == "cutoff_inclusive":
        inc = {t: df for t, df in logs.items()}
        p = _pick(inc[S.PURCHASE].where(F.col("ingestion_ts") <= cut), PK, [F.desc("event_ts"), F.desc("ingestion_ts")])
        i = _pick(inc[S.ITEM].where(F.col("ingestion_ts") <= cut), S.ENTITY_KEYS[S.ITEM],
                  [F.desc("event_ts"), F.desc("ingestion_ts")])
        e = _pick(inc[S.EXTRA].where(F.col("ingestion_ts") <= cut), PK, [F.desc("event_ts"), F.desc("ingestion_ts")])
    elif name == "order_by_arrival_first":
        p = _pick(logs[S.PURCHASE].where(F.col("ingestion_ts") < cut), PK, [F.desc("ingestion_ts"), F.desc("event_ts")])
    elif name == "eligibility_before_pick":
        p = latest_as_of(logs[S.PURCHASE].where(purchase_eligible()), PK, RUN.cutoff_ts)
    elif name == "deletes_dropped_before_pick":
        p = latest_as_of(logs[S.PURCHASE].where(F.col("op") != "d"), PK, RUN.cutoff_ts)
    elif name == "deleted_extra_dropped":
        e = e.where(F.col("op") != "d")
    elif name == "null_status_excluded":
        p = p.where(F.col("purchase_status").isNotNull())
    elif name == "deleted_items_kept":
        i = i.withColumn("op", F.lit("c"))
    elif name == "null_quantity_as_zero":
        i = i.withColumn("item_quantity", F.coalesce("item_quantity", F.lit(0)))
    else:
        raise ValueError(name)
    return _snapshot(p, e, i)


@pytest.mark.parametrize("name", [
    "cutoff_inclusive", "order_by_arrival_first", "eligibility_before_pick", "deletes_dropped_before_pick",
    "deleted_extra_dropped", "null_status_excluded", "deleted_items_kept", "null_quantity_as_zero",
])
def test_mutant_is_caught(small_logs, spark, name):
    from tempora.sources.testdata import cdc_logs
    logs = cdc_logs(spark, "/root/testdata/sf0.01") if name == "cutoff_inclusive" else small_logs
    right = _rows(_snapshot(*_silver(logs)))
    assert _rows(_mutant(logs, name)) != right


def test_item_amount_rule_is_null_safe(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(None, None), (2, None), (None, Decimal("3.00"))],
                               "item_quantity int, purchase_value decimal(18,2)")
    got = [r[0] for r in df.select(item_amount()).collect()]
    assert [float(x) for x in got] == [0.0, 0.0, 3.0]
