"""Contribution margin: GMV minus transaction costs per (day, subsidiary).

Costs take their latest version as of the same cutoff and are LEFT joined
(a purchase without cost keeps its GMV, cost 0). A deleted cost version still
counts, like the extra info. The cost pick is hash-partitioned on the
purchase key, as is the eligible set, so the left join adds no exchange.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora import schemas as S
from tempora.functions.metrics import rollup
from tempora.functions.rules import cost_total, not_deleted
from tempora.operators.gmv import COST_COLS, PK, eligible_at
from tempora.operators.latest import latest_as_of


def latest_cost(logs: Mapping[str, DataFrame], cutoff) -> DataFrame:
    return latest_as_of(logs[S.COST], PK, cutoff, COST_COLS)


def margin_grain(logs: Mapping[str, DataFrame], cutoff, honor_deletes: bool = False) -> DataFrame:
    """One row per eligible purchase with ``gmv_amount`` and ``_cost``.

    ``honor_deletes=True`` also ignores deleted extra-info and cost winners.
    """
    ep = eligible_at(logs, cutoff, honor_deletes).select(*PK, "transaction_date", "subsidiary", "gmv_amount")
    c = latest_cost(logs, cutoff)
    if honor_deletes:
        c = c.where(not_deleted())
    c = c.select(*PK, cost_total().alias("_cost"))
    return ep.join(c, PK, "left").withColumn("_cost", F.coalesce(F.col("_cost"), F.lit(0)))


def contribution_margin(logs: Mapping[str, DataFrame], cutoff, ordered: bool = True,
                        honor_deletes: bool = False) -> DataFrame:
    out = rollup(margin_grain(logs, cutoff, honor_deletes), ["transaction_date", "subsidiary"],
                 ["gmv", "cost", "contribution_margin"])
    if ordered:
        out = out.orderBy(F.col("transaction_date").asc_nulls_last(), F.col("subsidiary").asc_nulls_last())
    return out
