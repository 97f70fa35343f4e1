"""Semantic metrics: one governed definition per metric name.

Each metric is an aggregate Column over the eligible-purchase grain joined
with its latest cost; snapshots, the margin report and roll-ups all use these
definitions, so "gmv" means the same everywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.functions.rules import money

# Input columns of the metric grain: gmv_amount (per purchase) and _cost
# (VAT + installment of its latest cost version, 0 when absent).
METRICS: dict[str, callable] = {
    "gmv": lambda: money(F.sum("gmv_amount")),
    "cost": lambda: money(F.sum("_cost")),
    "contribution_margin": lambda: money(F.sum("gmv_amount") - F.sum("_cost")),
    "purchases_count": lambda: F.count(F.lit(1)).cast("int"),
}


def metric(name: str) -> Column:
    return METRICS[name]().alias(name)


def rollup(grain: DataFrame, by: Sequence[Column | str], names: Sequence[str]) -> DataFrame:
    """Aggregate the metric grain by ``by`` into the named metrics."""
    return grain.groupBy(*by).agg(*[metric(n) for n in names])
