"""Registered queries: one callable per operator key, ``(spark, sf_dir) -> DataFrame``.

Every query reads the test tables (the CDC logs are derived from them by
Spark), so its work grows with them. Queries that exercise a sink write to a
fresh folder under the shared checkpoint folder and return what they read
back. Snapshot runs used throughout (cutoff = the next midnight):
run 1 as of 1998-06-30, run 2 as of 1998-07-31, and 2001-12-31 (all data).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora import schemas as S
from tempora.functions.metrics import rollup
from tempora.functions.rules import RunParams, date_lit, known_before, purchase_eligible, status_counts, paid, not_deleted
from tempora.operators import compare, gmv, incremental, latest, margin, quality
from tempora.plans import jobs
from tempora.session import scratch_path
from tempora.sinks.gold import GoldTable
from tempora.sinks.raw import append_raw, raw_path, read_raw, write_raw
from tempora.sinks.silver import known_on
from tempora.sources import testdata as TD

# The runs of the test plan.
RUN1 = RunParams.for_day("1998-06-30")
RUN2 = RunParams.for_day("1998-07-31")
RUN_ALL = RunParams.for_day("2001-12-31")
AS_SEEN_ON = "1998-07-15"
PRUNED_MONTH = "1998-06-01"

PK = S.PURCHASE_KEY


def _logs(spark, sf_dir):
    return TD.cdc_logs(spark, sf_dir)


# -- sources -------------------------------------------------------------------

def _scan(table: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, f"raw-{table}")
        write_raw(TD.DERIVERS[table](spark, sf_dir, derived=True), path)
        return read_raw(spark, path, table)
    return q


def raw_derived_date(spark, sf_dir):
    parts = [TD.DERIVERS[t](spark, sf_dir, derived=True).select(F.lit(t).alias("log"), "transaction_date")
             for t in (S.PURCHASE, S.EXTRA, S.ITEM, S.COST)]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("log", "transaction_date").agg(F.count(F.lit(1)).cast("long").alias("events"))


def raw_append(spark, sf_dir):
    """Two appends (before / after run 1's cutoff) read back as one table."""
    path = scratch_path(spark, "raw-append")
    log = TD.purchase_cdc(spark, sf_dir)
    append_raw(spark, log.where(known_before(RUN1.cutoff_ts)), path, S.PURCHASE)
    append_raw(spark, log.where(~known_before(RUN1.cutoff_ts)), path, S.PURCHASE)
    return read_raw(spark, path, S.PURCHASE)


def raw_dedup_replay(spark, sf_dir):
    """Append run-1 events, then a replayed delivery of everything: stored = distinct events."""
    path = scratch_path(spark, "raw-replay")
    append_raw(spark, TD.purchase_cdc(spark, sf_dir).where(known_before(RUN1.cutoff_ts)), path, S.PURCHASE)
    append_raw(spark, TD.replayed_purchase_cdc(spark, sf_dir), path, S.PURCHASE)
    return read_raw(spark, path, S.PURCHASE)


def raw_key_conflicts(spark, sf_dir):
    """A second delivery repeats stored events, some with another value: the latter land in the quarantine."""
    path, quarantine = scratch_path(spark, "raw-conflicts"), scratch_path(spark, "quarantine")
    log = TD.purchase_cdc(spark, sf_dir)
    append_raw(spark, log.where("purchase_id % 3 = 0"), path, S.PURCHASE)
    value = F.expr("CASE WHEN purchase_id % 61 = 0 THEN coalesce(purchase_total_value, 0) + 1 ELSE purchase_total_value END")
    append_raw(spark, log.withColumn("purchase_total_value", value.cast("decimal(18,2)")), path, S.PURCHASE, quarantine)
    return spark.read.parquet(quarantine).select(*S.RAW_KEYS[S.PURCHASE], "reject_reason")


def known_as_of(spark, sf_dir):
    return TD.purchase_cdc(spark, sf_dir).where(known_before(RUN1.cutoff_ts))


def quality_gate_op(spark, sf_dir):
    _, rejected = quality.split(TD.dirty_purchase_cdc(spark, sf_dir), S.PURCHASE, check_nulls=False)
    return rejected.select(*PK, "op", "event_ts", "ingestion_ts", "reject_reason")


def quality_gate_nulls(spark, sf_dir):
    _, rejected = quality.split(TD.dirty_purchase_cdc(spark, sf_dir), S.PURCHASE, check_op=False)
    return rejected.select(*PK, "op", "event_ts", "ingestion_ts", "reject_reason")


# -- silver ----------------------------------------------------------------------

_PURCHASE_OUT = ["purchase_id", "purchase_partition", "buyer_id", "prod_item_id", "prod_item_partition",
                 "producer_id", "order_date", "release_date", "purchase_total_value", "purchase_status",
                 "op", "event_ts", "ingestion_ts"]


def latest_purchase(spark, sf_dir):
    return latest.latest_as_of(TD.purchase_cdc(spark, sf_dir), PK, RUN1.cutoff_ts).select(*_PURCHASE_OUT)


def latest_purchase_param(spark, sf_dir):
    """The same pick over a relation cut off by a named parameter."""
    known = spark.sql("SELECT * FROM {log} WHERE ingestion_ts < to_timestamp_ntz(:cutoff)",
                      args={"cutoff": RUN1.cutoff_literal}, log=TD.purchase_cdc(spark, sf_dir))
    return latest.latest_as_of(known, PK).select(*_PURCHASE_OUT)


def latest_extra(spark, sf_dir):
    return latest.latest_as_of(TD.extra_cdc(spark, sf_dir), PK, RUN1.cutoff_ts)


def latest_item(spark, sf_dir):
    return latest.latest_as_of(TD.item_cdc(spark, sf_dir, distinct=False), S.ENTITY_KEYS[S.ITEM], RUN1.cutoff_ts)


def latest_cost(spark, sf_dir):
    return latest.latest_as_of(TD.cost_cdc(spark, sf_dir), PK, RUN1.cutoff_ts)


def items_by_purchase(spark, sf_dir):
    s = gmv.silver(_logs(spark, sf_dir), RUN1.cutoff_ts)
    return gmv.items_by_purchase(s["item"])


def eligible_purchases(spark, sf_dir):
    return gmv.eligible_at(_logs(spark, sf_dir), RUN1.cutoff_ts)


def expr_null_rules(spark, sf_dir):
    """Three-valued rule results per latest purchase (NULL status, NULL release)."""
    p = latest.latest_as_of(TD.purchase_cdc(spark, sf_dir), PK, RUN1.cutoff_ts)
    return p.select(
        *PK, "purchase_status",
        F.col("purchase_status").isin(*S.EXCLUDED_STATUSES).alias("status_excluded"),
        status_counts().alias("status_counts"),
        paid().alias("paid"),
        not_deleted().alias("live"),
        purchase_eligible().alias("eligible"),
        F.greatest(F.col("release_date"), F.col("order_date")).alias("latest_date"),
    )


# -- gold ------------------------------------------------------------------------

def gmv_snapshot(spark, sf_dir, run: RunParams = RUN1):
    return gmv.gmv_snapshot(_logs(spark, sf_dir), run)


def snapshot_cross_params(spark, sf_dir):
    """Run values joined on from a one-row relation: totals first, then the cross with the broadcast row (never with purchases)."""
    totals = gmv.aggregate_snapshot(gmv.eligible_at(_logs(spark, sf_dir), RUN2.cutoff_ts))
    run = params_relation(spark, sf_dir, RUN2).drop("cutoff_ts")
    return totals.crossJoin(F.broadcast(run)).select(*S.GOLD_COLUMNS)


def params_relation(spark, sf_dir, run: RunParams | None = None):
    """One-row relation (as_of_date, cutoff_ts, run_id).

    Without ``run``: the D-1 run of the data's newest ingest day, derived by
    one global aggregate over the purchase log (exactly one row).
    """
    if run is not None:
        return spark.range(1).select(date_lit(run.as_of_date).alias("as_of_date"),
                                     F.lit(run.cutoff_literal).cast("timestamp_ntz").alias("cutoff_ts"),
                                     F.lit(run.run_id).alias("run_id"))
    newest = TD.purchase_cdc(spark, sf_dir).agg(F.max(F.to_date("ingestion_ts")).alias("d"))
    as_of = F.date_sub(F.col("d"), 1)
    return newest.select(
        as_of.alias("as_of_date"),
        F.col("d").cast("timestamp_ntz").alias("cutoff_ts"),
        F.concat(as_of.cast("string"), F.lit("_d-1")).alias("run_id"),
    )


def _gold_with_runs(spark, sf_dir, runs=(RUN1, RUN2)) -> GoldTable:
    g = GoldTable(spark, scratch_path(spark, "gold"))
    logs = _logs(spark, sf_dir)
    for r in runs:
        g.append(gmv.gmv_snapshot(logs, r))
    return g


def snapshot_append(spark, sf_dir):
    """Run 2 appended on top of run 1: the rows read back for run 2."""
    return _gold_with_runs(spark, sf_dir).as_of(RUN2.as_of_date)


def snapshot_rerun_guard(spark, sf_dir):
    """Colliding keys when run 1 is submitted again (append would raise)."""
    g = _gold_with_runs(spark, sf_dir, (RUN1,))
    return g.collisions(gmv.gmv_snapshot(_logs(spark, sf_dir), RUN1))


def gmv_hist(spark, sf_dir):
    return _gold_with_runs(spark, sf_dir).history()


def latest_as_of_date(spark, sf_dir):
    return _gold_with_runs(spark, sf_dir).latest_as_of_date()


def gmv_current(spark, sf_dir):
    return _gold_with_runs(spark, sf_dir).current()


def gmv_current_report(spark, sf_dir):
    return jobs.short_report(_gold_with_runs(spark, sf_dir).current())


def gmv_as_of(spark, sf_dir):
    return jobs.short_report(_gold_with_runs(spark, sf_dir).as_of(RUN1.as_of_date))


def gmv_as_of_full(spark, sf_dir):
    """Validation read: run 1's snapshot, all columns, ordered."""
    return jobs.whole_snapshot(_gold_with_runs(spark, sf_dir).as_of(RUN1.as_of_date))


def gmv_current_full(spark, sf_dir):
    return jobs.whole_snapshot(_gold_with_runs(spark, sf_dir).current())


def gmv_month_pruned(spark, sf_dir):
    return _gold_with_runs(spark, sf_dir).month(PRUNED_MONTH)


def multi_snapshot(spark, sf_dir):
    return gmv.multi_snapshot(_logs(spark, sf_dir), [RUN1, RUN2, RUN_ALL])


def contribution_margin(spark, sf_dir):
    return margin.contribution_margin(_logs(spark, sf_dir), RUN1.cutoff_ts)


def _stored_logs(spark, sf_dir) -> str:
    """The three logs of a snapshot as a RAW store in two deliveries: what run 1 knew, and the rest."""
    root = scratch_path(spark, "raw")
    for t in jobs.SNAPSHOT_LOGS:
        # exact copies of an item event may stay in: the append keeps one
        log = TD.item_cdc(spark, sf_dir, distinct=False) if t == S.ITEM else TD.DERIVERS[t](spark, sf_dir)
        for part in (log.where(known_before(RUN1.cutoff_ts)), log.where(~known_before(RUN1.cutoff_ts))):
            append_raw(spark, part, raw_path(root, t), t)
    return root


def snapshot_from_silver(spark, sf_dir):
    """Run 2 from bucketed silver: states by a filter, joins and item sums without an exchange on the purchase key."""
    root = _stored_logs(spark, sf_dir)
    silver = jobs.silver_store(spark, root)
    silver.refresh(root)
    names = silver.publish_bucketed(f"silver_{uuid.uuid4().hex[:8]}")
    return gmv.snapshot_from_states(*[known_on(spark.table(names[t]), RUN2.as_of_date) for t in (S.PURCHASE, S.EXTRA, S.ITEM)], RUN2)


def incremental_from_silver(spark, sf_dir):
    """Run 2 from run 1's snapshot and silver as of run 1, with the later delivery laid over it."""
    root = _stored_logs(spark, sf_dir)
    silver, logs = jobs.silver_store(spark, root), jobs.raw_logs(spark, root, jobs.SNAPSHOT_LOGS)
    silver.refresh(root, dict.fromkeys(jobs.SNAPSHOT_LOGS, 1))
    previous = gmv.gmv_snapshot(logs, RUN1).checkpoint()
    fresh = jobs.arrivals(logs, RUN1, RUN2, dict.fromkeys(jobs.SNAPSHOT_LOGS, 1))
    return incremental.incremental_from(silver.with_recent(root, dict.fromkeys(jobs.SNAPSHOT_LOGS, 2)), fresh, previous, RUN2)


# -- second tier -------------------------------------------------------------------

def impacted_dates(spark, sf_dir):
    return incremental.impacted_dates(_logs(spark, sf_dir), RUN1, RUN2)


def incremental_snapshot(spark, sf_dir):
    g = _gold_with_runs(spark, sf_dir, (RUN1,))
    return incremental.incremental_snapshot(_logs(spark, sf_dir), g.as_of(RUN1.as_of_date), RUN1, RUN2)


def snapshot_diff(spark, sf_dir):
    g = _gold_with_runs(spark, sf_dir)
    return compare.snapshot_diff(g.as_of(RUN1.as_of_date), g.as_of(RUN2.as_of_date))


def month_as_seen_vs_now(spark, sf_dir):
    g = _gold_with_runs(spark, sf_dir)
    return compare.month_as_seen_vs_now(g.as_seen_on(AS_SEEN_ON), g.current())


def gmv_by_year_ordinals(spark, sf_dir):
    """Grouping and ordering by position, in SQL over the stored history."""
    return spark.sql("SELECT subsidiary, year(transaction_date) AS sales_year, sum(gmv_amount) AS gmv FROM {gold} GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2",
                     gold=_gold_with_runs(spark, sf_dir).current()).withColumn("gmv", F.col("gmv").cast(S.MONEY))


def metric_by_month(spark, sf_dir):
    grain = margin.margin_grain(_logs(spark, sf_dir), RUN2.cutoff_ts)
    return rollup(grain, [F.trunc("transaction_date", "month").alias("transaction_month"), "subsidiary"],
                  ["gmv", "cost", "contribution_margin", "purchases_count"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_purchase_cdc": _scan(S.PURCHASE),
    "scan_item_cdc": _scan(S.ITEM),
    "scan_extra_cdc": _scan(S.EXTRA),
    "scan_cost_cdc": _scan(S.COST),
    "params_relation": params_relation,
    "known_as_of": known_as_of,
    "raw_derived_date": raw_derived_date,
    "raw_append": raw_append,
    "raw_dedup_replay": raw_dedup_replay,
    "raw_key_conflicts": raw_key_conflicts,
    "quality_gate_op": quality_gate_op,
    "quality_gate_nulls": quality_gate_nulls,
    "latest_purchase": latest_purchase,
    "latest_purchase_param": latest_purchase_param,
    "latest_extra": latest_extra,
    "latest_item": latest_item,
    "latest_cost": latest_cost,
    "items_by_purchase": items_by_purchase,
    "eligible_purchases": eligible_purchases,
    "expr_null_rules": expr_null_rules,
    "gmv_snapshot": gmv_snapshot,
    "snapshot_cross_params": snapshot_cross_params,
    "snapshot_append": snapshot_append,
    "snapshot_rerun_guard": snapshot_rerun_guard,
    "gmv_hist": gmv_hist,
    "latest_as_of_date": latest_as_of_date,
    "gmv_current": gmv_current,
    "gmv_current_report": gmv_current_report,
    "gmv_as_of": gmv_as_of,
    "gmv_as_of_full": gmv_as_of_full,
    "gmv_current_full": gmv_current_full,
    "gmv_month_pruned": gmv_month_pruned,
    "multi_snapshot": multi_snapshot,
    "snapshot_from_silver": snapshot_from_silver,
    "contribution_margin": contribution_margin,
    "impacted_dates": impacted_dates,
    "incremental_snapshot": incremental_snapshot,
    "incremental_from_silver": incremental_from_silver,
    "snapshot_diff": snapshot_diff,
    "month_as_seen_vs_now": month_as_seen_vs_now,
    "metric_by_month": metric_by_month,
    "gmv_by_year_ordinals": gmv_by_year_ordinals,
}
