"""Production entry points: the daily workflow on stored RAW and GOLD tables.

* ``ingest``: gate, check, de-duplicate and append a delivery of RAW events
  (refused if it breaks a rule and no quarantine is named);
* ``daily_snapshot``: the D-1 run (incremental from the newest stored
  snapshot when there is one, full otherwise), appended to GOLD once;
* ``backfill``: all missing daily snapshots of a date range in one job;
* ``reports``: current, as-of and margin reports.

Paths are folders on the cluster's shared storage: ``raw_root/<log name>``
for the four RAW logs, one folder for GOLD.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora import schemas as S
from tempora.functions.rules import RunParams
from tempora.operators import gmv, incremental, margin
from tempora.sinks.gold import GoldTable
from tempora.sinks.raw import append_raw, newest_delivery, raw_path, read_raw
from tempora.sinks.silver import MERGE_EVERY, SilverStore

LOGS = (S.PURCHASE, S.EXTRA, S.ITEM, S.COST)
SNAPSHOT_LOGS = LOGS[:3]


def ingest(spark: SparkSession, batch: DataFrame, raw_root: str, table: str, quarantine: str | None = None) -> dict:
    """Append one delivery of ``table`` events to the RAW store."""
    return append_raw(spark, batch, raw_path(raw_root, table), table, quarantine)


def raw_logs(spark: SparkSession, raw_root: str, tables=LOGS, covered: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """The stored logs, as far as the deliveries in ``covered`` if given (a folder filter)."""
    logs = {t: read_raw(spark, raw_path(raw_root, t), t, with_partition=True) for t in tables}
    return {t: df.where(F.col("delivery_id") <= covered[t]) if covered else df for t, df in logs.items()}


def silver_store(spark: SparkSession, raw_root: str) -> SilverStore:
    """The silver store kept beside the RAW logs."""
    return SilverStore(spark, raw_root.rstrip("/") + "__silver")


def arrivals(logs: dict[str, DataFrame], prev: RunParams, new: RunParams, covered: dict[str, int]) -> dict[str, DataFrame]:
    """Per log the events known at ``new`` that ``prev``, which saw the deliveries ``covered``, did not see."""
    return {t: incremental.new_events(logs[t], prev.cutoff_ts, new.cutoff_ts, covered.get(t)) for t in SNAPSHOT_LOGS}


def daily_snapshot(spark: SparkSession, raw_root: str, gold_path: str, as_of_date,
                   mode: str = "auto", honor_deletes: bool = False) -> bool:
    """Compute and append the snapshot for ``as_of_date``; False if already stored.

    ``mode``: ``incremental`` starts from the newest earlier snapshot,
    ``full`` from nothing; the rows are the same. ``auto`` is incremental
    where it can be: an earlier snapshot is stored, it is known what that
    run was made from, and it followed the default delete rule.
    """
    if mode not in ("auto", "full", "incremental"):
        raise ValueError(mode)
    if honor_deletes and mode == "incremental":
        raise ValueError("incremental runs follow the default delete rule; use mode='full'")
    run = RunParams.for_day(as_of_date)
    gold = GoldTable(spark, gold_path)
    if gold.is_stored(run.as_of_date):
        return False
    covered = {t: newest_delivery(spark, raw_path(raw_root, t)) for t in SNAPSHOT_LOGS}
    logs = raw_logs(spark, raw_root, SNAPSHOT_LOGS, covered)
    snap = snapshot_for(gold, logs, run, raw_root, covered, mode, honor_deletes)
    return gold.append(snap, if_stored="skip", dates=[run.as_of_date], covered=covered, honor_deletes=honor_deletes)


def snapshot_for(gold: GoldTable, logs: dict[str, DataFrame], run: RunParams, raw_root: str, covered: dict[str, int],
                 mode: str = "auto", honor_deletes: bool = False) -> DataFrame:
    """The snapshot of ``run``, from the newest earlier one where ``mode`` and what is known of that run allow it.

    ``logs`` hold the deliveries up to ``covered`` of the RAW store at
    ``raw_root``. An incremental run lays those that the silver store has not
    merged over it (or merges them, once there are many); where that store is ahead of ``covered`` already (an
    older run is made up for), it reads the logs alone. A first run in mode
    ``auto`` makes the silver store and takes its states, so the logs are not
    picked once for the snapshot and once more for silver.
    """
    prev_date = None
    if mode != "full" and not honor_deletes:
        prev_date = max((d for d in gold.run_dates() if d < run.as_of_date), default=None)
    made = gold.covered_by(prev_date) if prev_date is not None else None
    usable = made is not None and not made[1]
    if mode == "incremental" and not usable:
        raise ValueError("an incremental run needs an earlier stored snapshot made under the default delete rule")
    first = mode == "auto" and not honor_deletes and not gold.exists()
    if not usable and not first:
        return gmv.gmv_snapshot(logs, run, honor_deletes=honor_deletes)
    silver = silver_store(gold.spark, raw_root)
    merged = silver.refresh(raw_root, covered, MERGE_EVERY)
    behind = any(merged[t] > covered[t] for t in merged)
    if first and behind:
        return gmv.gmv_snapshot(logs, run)
    if first:
        silver = silver.with_recent(raw_root, covered)
        return gmv.snapshot_from_states(*[silver.state(t, run.as_of_date) for t in (S.PURCHASE, S.EXTRA, S.ITEM)], run)
    prev = RunParams.for_day(prev_date)
    if behind:
        return incremental.incremental_snapshot(logs, gold.as_of(prev.as_of_date), prev, run, made[0])
    silver = silver.with_recent(raw_root, covered)
    return incremental.incremental_from(silver, arrivals(logs, prev, run, made[0]), gold.as_of(prev.as_of_date), run)


def backfill(spark: SparkSession, raw_root: str, gold_path: str, first_day, last_day) -> list:
    """Every missing daily snapshot in ``[first_day, last_day]``, in ONE job.

    The multi-cutoff pick reads and shuffles each log once for all the days;
    the snapshots are appended together (guarded). Returns the days written.
    """
    first, last = RunParams.for_day(first_day).as_of_date, RunParams.for_day(last_day).as_of_date
    gold = GoldTable(spark, gold_path)
    stored = set(gold.run_dates())
    days = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
    runs = [RunParams.for_day(d) for d in days if d not in stored]
    if not runs:
        return []
    covered = {t: newest_delivery(spark, raw_path(raw_root, t)) for t in SNAPSHOT_LOGS}
    missing = [r.as_of_date for r in runs]
    gold.append(gmv.multi_snapshot(raw_logs(spark, raw_root, SNAPSHOT_LOGS, covered), runs), dates=missing, covered=covered)
    return [r.as_of_date for r in runs]


def current_report(spark: SparkSession, gold_path: str, whole: bool = False) -> DataFrame:
    return (whole_snapshot if whole else short_report)(GoldTable(spark, gold_path).current())


def as_of_report(spark: SparkSession, gold_path: str, as_of_date, whole: bool = False) -> DataFrame:
    return (whole_snapshot if whole else short_report)(GoldTable(spark, gold_path).as_of(as_of_date))


def margin_report(spark: SparkSession, raw_root: str, as_of_date) -> DataFrame:
    return margin.contribution_margin(raw_logs(spark, raw_root), RunParams.for_day(as_of_date).cutoff_ts)


def ordered(df: DataFrame) -> DataFrame:
    """By day and subsidiary, NULLs last."""
    return df.orderBy(F.col("transaction_date").asc_nulls_last(), F.col("subsidiary").asc_nulls_last())


def short_report(df: DataFrame) -> DataFrame:
    return ordered(df.select("transaction_date", "subsidiary", "gmv_amount"))


def whole_snapshot(df: DataFrame) -> DataFrame:
    """A snapshot with all its columns, in report order (the validation read)."""
    return ordered(df.select(*S.GOLD_COLUMNS))
