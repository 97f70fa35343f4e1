"""Latest known state of each entity as of a cutoff (the as-of lookup).

For every entity key, among the events that had *arrived* before the cutoff
(``ingestion_ts < cutoff``), the version with the highest ``event_ts`` wins,
ties broken by the highest ``ingestion_ts``. An event that arrives late with
an older ``event_ts`` does not win. The winner keeps its ``op``: deletes and
eligibility are judged by the caller *after* the pick, never before.

Physical plan: the cutoff is pushed into the parquet scan; the top-1 filter
over ``row_number`` becomes a partial ``WindowGroupLimit`` before the shuffle
(one row per key per map task crosses the network, which also defuses a key
holding a huge number of versions) and a final one after it. The output is
hash-partitioned on the entity key, so later joins on that key reuse it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.functions.rules import RunParams, _ntz_sql, date_lit, known_before

ORDER = ("event_ts", "ingestion_ts")


def _pick(df: DataFrame, partition: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*partition).orderBy(*[F.col(c).desc() for c in ORDER])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def prune_ingest_days(df: DataFrame, cutoff) -> DataFrame:
    """Add the bounds implied by the cutoff on the derived ingest columns.

    ``transaction_date`` (ingest day) and ``ingest_month`` (RAW partition
    folder) are functions of ``ingestion_ts`` that Spark cannot relate to it
    on its own; stating the bound lets the scan skip folders and row groups.
    """
    cols = set(df.columns)
    day = f"to_date({_ntz_sql(cutoff)})"
    bounds = []
    if "transaction_date" in cols:
        bounds.append(f"transaction_date <= {day}")
    if "ingest_month" in cols:
        bounds.append(f"ingest_month <= trunc({day}, 'month')")
    return df.where(" AND ".join(bounds)) if bounds else df


def latest_as_of(events: DataFrame, keys: Sequence[str], cutoff=None,
                 columns: Iterable[str] | None = None) -> DataFrame:
    """One row per key: the winning version known before ``cutoff``.

    ``cutoff`` is a datetime / ISO string (strict bound) or None for "all
    that has arrived". ``columns`` optionally projects the payload first, so
    only what the caller needs is read and shuffled.
    """
    df = events
    if cutoff is not None:
        df = prune_ingest_days(df, cutoff).where(known_before(cutoff))
    if columns is not None:
        keep = list(dict.fromkeys([*keys, *columns, "op", *ORDER]))
        df = df.select(*keep)
    return _pick(df, keys)


def run_bucket(runs: Sequence[RunParams], col: str = "ingestion_ts"):
    """Index of the first run (of runs in cutoff order) that sees an event."""
    bucket = F.when(known_before(runs[0].cutoff_ts, col), F.lit(0))
    for b, r in enumerate(runs[1:], start=1):
        bucket = bucket.when(known_before(r.cutoff_ts, col), F.lit(b))
    return bucket


def latest_intervals(events: DataFrame, keys: Sequence[str], runs: Sequence[RunParams],
                     columns: Iterable[str] | None = None) -> DataFrame:
    """The pick for several cutoffs in one job, one row per winner with the runs it wins: ``first_run`` to ``last_run``.

    ``runs`` must be in cutoff order. Each event belongs to the bucket of the
    first run that sees it. The best version per (key, bucket) is trimmed by a
    partial group limit before its shuffle; only these change candidates are
    shuffled by key, where a running maximum tells which of them win and the
    next winner ends the interval. Keys that do not change between runs give
    one row, however many runs there are.
    """
    df = events
    if columns is not None:
        df = df.select(*dict.fromkeys([*keys, *columns, "op", *ORDER]))
    last = runs[-1].cutoff_ts
    df = prune_ingest_days(df, last).where(known_before(last)).withColumn("first_run", run_bucket(runs))
    best = _pick(df, [*keys, "first_run"])
    by = Window.partitionBy(*keys).orderBy("first_run")
    version = F.struct(*ORDER)
    before = F.max(version).over(by.rowsBetween(Window.unboundedPreceding, -1))
    wins = best.withColumn("_before", before).where(F.col("_before").isNull() | (version > F.col("_before"))).drop("_before")
    return wins.withColumn("last_run", F.coalesce(F.lead("first_run").over(by) - 1, F.lit(len(runs) - 1)))
