"""Daily GOLD snapshots kept beside the stream.

A snapshot for ``as_of_date`` D needs every event that arrived before the
midnight after D. The bronze streams record how far arrivals have got; once
the slowest of the three logs (purchase, extra info, item), minus the
allowed lateness, has passed that midnight, D is due and is computed from
the bronze store (incrementally from the previous stored snapshot), then
appended to GOLD (guarded: a snapshot is never written twice, so re-running
after a crash is safe).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.functions.rules import RunParams, date_lit
from tempora.plans.jobs import SNAPSHOT_LOGS, snapshot_for
from tempora.sinks.gold import GoldTable
from tempora.sinks.raw import newest_delivery, read_raw
from tempora.streaming.ingest import arrived_until, bronze_path


def ingest_watermark(spark: SparkSession, bronze_root: str, lateness: dt.timedelta) -> dt.datetime | None:
    marks = [arrived_until(spark, bronze_path(bronze_root, t)) for t in SNAPSHOT_LOGS]
    if any(m is None for m in marks):
        return None
    return min(marks) - lateness


def due_days(schedule: Iterable, watermark: dt.datetime | None, done: set) -> list[RunParams]:
    if watermark is None:
        return []
    runs = [RunParams.for_day(d) for d in schedule]
    return [r for r in runs if r.cutoff_ts <= watermark and r.as_of_date not in done]


def emit_due_snapshots(spark: SparkSession, bronze_root: str, gold: GoldTable, schedule: Iterable,
                       lateness: dt.timedelta = dt.timedelta(0)) -> list[RunParams]:
    """Append every scheduled snapshot whose cutoff the accepted arrivals have passed by ``lateness``.

    A snapshot with a stored predecessor is built incrementally from it, with
    all that has entered the store since, late stamps included. Events that
    arrive even later than ``lateness`` are not lost: ``incomplete_runs`` names
    the stored snapshots that miss them, and the next snapshot has them.
    """
    wm = ingest_watermark(spark, bronze_root, lateness)
    runs = due_days(schedule, wm, set(gold.run_dates()))
    if runs:
        covered = {t: newest_delivery(spark, bronze_path(bronze_root, t)) for t in SNAPSHOT_LOGS}
        logs = {t: read_raw(spark, bronze_path(bronze_root, t), t, with_partition=True).where(F.col("delivery_id") <= covered[t])
                for t in SNAPSHOT_LOGS}
        for r in sorted(runs, key=lambda x: x.as_of_date):
            snap = snapshot_for(gold, logs, r, bronze_root, covered)
            gold.append(snap, if_stored="skip", dates=[r.as_of_date], covered=covered)
    return runs


def incomplete_runs(spark: SparkSession, bronze_root: str, gold: GoldTable) -> DataFrame:
    """(as_of_date, log, late_events): stored snapshots and the events that entered the store too late for them."""
    seen = {d: made[0] for d in gold.run_dates() if (made := gold.covered_by(d))}  # one note per run
    out = None
    for t in SNAPSHOT_LOGS:
        part = _late_events(read_raw(spark, bronze_path(bronze_root, t), t, with_partition=True), t, {d: c[t] for d, c in seen.items() if t in c})
        out = part if out is None else out.unionByName(part)
    return out


def _late_events(log: DataFrame, table: str, seen: dict[dt.date, int]) -> DataFrame:
    """Late events per run, by a sweep over the runs in date order.

    Where later runs have seen at least the deliveries of earlier ones, a
    (day, delivery) total is late for the runs from the first one at or after
    the day up to the last one that had not seen the delivery: it is added at
    the first and taken off after the last, and running sums give the counts.
    Runs out of that order (made up for later) are swept in chains of their own.
    """
    spark, parts = log.sparkSession, []
    chains: list[list[dt.date]] = []
    for d in sorted(seen):
        chain = next((c for c in chains if seen[c[-1]] <= seen[d]), None)
        if chain is None:
            chains.append([d])
        else:
            chain.append(d)
    # the deliveries some run has not seen, one row per day and delivery
    totals = (log.where(F.col("delivery_id") > F.lit(min(seen.values(), default=0)).cast("long"))
              .groupBy("transaction_date", "delivery_id").agg(F.count(F.lit(1)).alias("n")))
    for chain in chains:
        runs = spark.createDataFrame([(i, d, seen[d]) for i, d in enumerate(chain)], "run int, as_of_date date, seen long")
        dates = F.array(*[date_lit(d) for d in chain])
        marks = F.array(*[F.lit(seen[d]).cast("long") for d in chain])
        first = F.size(F.filter(dates, lambda d: d < F.col("transaction_date")))
        after = F.size(F.filter(marks, lambda m: m < F.col("delivery_id")))
        steps = totals.select(first.alias("first"), after.alias("after"), "n").where("first < after")
        ends = F.explode(F.array(F.struct(F.col("first").alias("run"), F.col("n").alias("n")), F.struct(F.col("after").alias("run"), (-F.col("n")).alias("n"))))
        change = steps.select(ends.alias("e")).groupBy(F.col("e.run").alias("run")).agg(F.sum("e.n").alias("change"))
        swept = runs.join(change, "run", "left").withColumn("late_events", F.sum(F.coalesce("change", F.lit(0))).over(Window.orderBy("run")))
        parts.append(swept.where("late_events > 0").select("as_of_date", F.lit(table).alias("log"), "late_events"))
    empty = spark.createDataFrame([], "as_of_date date, log string, late_events long")
    for part in parts:
        empty = empty.unionByName(part)
    return empty
