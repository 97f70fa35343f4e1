"""Comparing snapshots: two snapshots side by side, and a month as it was
seen on a given day against how it is seen now."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.functions.metrics import METRICS
from tempora.functions.rules import money

DAY_SUB = ["transaction_date", "subsidiary"]


def snapshot_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Full outer join of two snapshots on (day, subsidiary).

    ``change`` is appeared / vanished / changed / same; ``delta_gmv`` is
    new minus old with a missing side as 0, so old + delta = new.
    """
    o = old.select(*DAY_SUB, F.col("gmv_amount").alias("old_gmv"), F.col("purchases_count").alias("old_count"))
    n = new.select(*DAY_SUB, F.col("gmv_amount").alias("new_gmv"), F.col("purchases_count").alias("new_count"))
    j = o.join(n, DAY_SUB, "full_outer")
    change = (F.when(F.col("old_gmv").isNull(), F.lit("appeared"))
              .when(F.col("new_gmv").isNull(), F.lit("vanished"))
              .when((F.col("old_gmv") != F.col("new_gmv")) | (F.col("old_count") != F.col("new_count")),
                    F.lit("changed"))
              .otherwise(F.lit("same")))
    delta = money(F.coalesce(F.col("new_gmv"), F.lit(0)) - F.coalesce(F.col("old_gmv"), F.lit(0)))
    return j.select(*DAY_SUB, "old_gmv", "new_gmv", delta.alias("delta_gmv"), "old_count", "new_count",
                    change.alias("change"))


def monthly(snapshot: DataFrame, name: str) -> DataFrame:
    return (snapshot.groupBy(F.trunc("transaction_date", "month").alias("transaction_month"), "subsidiary")
            .agg(METRICS["gmv"]().alias(name)))


def month_as_seen_vs_now(as_seen: DataFrame, current: DataFrame) -> DataFrame:
    """Monthly GMV per subsidiary as seen then, as seen now, and the change."""
    key = ["transaction_month", "subsidiary"]
    j = monthly(as_seen, "gmv_as_seen").join(monthly(current, "gmv_now"), key, "full_outer")
    delta = money(F.coalesce(F.col("gmv_now"), F.lit(0)) - F.coalesce(F.col("gmv_as_seen"), F.lit(0)))
    return j.select(*key, "gmv_as_seen", "gmv_now", delta.alias("delta_gmv"))
