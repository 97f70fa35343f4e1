"""GOLD store: append-only daily GMV snapshots, published whole.

Layout: ``as_of_date=<run>/attempt=<id>/transaction_month=<first day>``. A run
counts once its note (``<path>__runs/<run>``) is there, and the note is written
after the rows: a run that died while writing is invisible and is written anew,
and of two writers of one run one publishes and the other is refused. Notes say
which attempt counts, how many rows it has and what it was made from, so the
newest run is found by a listing, and reads list the folder of their run alone.

Parquet has no key and no transaction, so ``append`` checks first (NOT NULL,
unique key within the snapshot, run not stored) and only then writes new
folders; existing folders are never touched.
"""

from __future__ import annotations

import datetime as dt
import operator
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora import schemas as S
from tempora.functions.rules import date_lit
from tempora.session import ensure_checkpoint_dir
from tempora.sinks.notes import Notes

ATTEMPT = "attempt"
STORED_SCHEMA = T.StructType(list(S.GOLD_SCHEMA.fields) + [T.StructField(ATTEMPT, T.StringType(), True),
                                                           T.StructField("transaction_month", T.DateType(), True)])


class SnapshotError(ValueError):
    """A snapshot breaks a GOLD constraint (NULL, duplicate key, rerun)."""


class GoldTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.runs = Notes(spark, self.path + "__runs")
        ensure_checkpoint_dir(spark)

    # -- runs ----------------------------------------------------------------
    def run_dates(self) -> list[dt.date]:
        """Dates of the complete runs, in order (a listing)."""
        return [dt.date.fromisoformat(n) for n in self.runs.names()]

    def exists(self) -> bool:
        return bool(self.runs.names())

    def is_stored(self, as_of_date) -> bool:
        return _iso(as_of_date) in self.runs.names()

    def note(self, as_of_date) -> dict:
        """{attempt, rows, covered, honor_deletes} of a complete run."""
        return self.runs.read(_iso(as_of_date))

    def newest_run(self, until=None) -> dt.date | None:
        """The newest run that has rows (at or before ``until`` if given): its note is read, no data."""
        for name in reversed(self.runs.names()):
            if (until is None or name <= _iso(until)) and self.runs.read(name)["rows"]:
                return dt.date.fromisoformat(name)
        return None

    # -- reads -------------------------------------------------------------
    def _read(self, dates: Sequence) -> DataFrame:
        """Rows of complete runs: only their own folders are listed and read."""
        complete = set(self.runs.names())
        kept = [n for n in map(_iso, dates) if n in complete]
        paths = [f"{self.path}/as_of_date={n}/{ATTEMPT}={note['attempt']}" for n in kept if (note := self.runs.read(n))["rows"]]
        if not paths:
            return self.spark.createDataFrame([], STORED_SCHEMA)
        return self.spark.read.schema(STORED_SCHEMA).option("basePath", self.path).parquet(*paths)

    def stored(self) -> DataFrame:
        """All rows of complete runs, with the partition column ``transaction_month``."""
        return self._read(self.run_dates()).drop(ATTEMPT)

    def history(self) -> DataFrame:
        return self.stored().select(*S.GOLD_COLUMNS)

    def latest_as_of_date(self) -> DataFrame:
        """One row: the newest snapshot date (NULL before the first), from the notes."""
        newest = self.newest_run()
        return self.spark.range(1).select((date_lit(newest) if newest else F.lit(None).cast("date")).alias("as_of_date"))

    def current(self) -> DataFrame:
        """Rows of the newest snapshot (global max, not newest per day)."""
        return self.as_of(self.newest_run())

    def as_of(self, as_of_date) -> DataFrame:
        if as_of_date is None:
            return self.spark.createDataFrame([], S.GOLD_SCHEMA)
        return self._read([as_of_date]).where(F.col("as_of_date") == date_lit(as_of_date)).select(*S.GOLD_COLUMNS)

    def as_seen_on(self, day) -> DataFrame:
        """The snapshot an analyst saw on ``day``: newest ``as_of_date <= day``."""
        return self.as_of(self.newest_run(day))

    def month(self, month_start) -> DataFrame:
        return self.stored().where(F.col("transaction_month") == date_lit(month_start)).select(*S.GOLD_COLUMNS)

    # -- writes ------------------------------------------------------------
    def collisions(self, snapshot: DataFrame, dates: Sequence | None = None) -> DataFrame:
        """Keys of ``snapshot`` already stored (a rerun of a stored run).

        ``dates`` are the snapshot's as_of_dates (one per run; found here if
        not given): only their folders are read.
        """
        if dates is None:
            dates = [r[0] for r in snapshot.select("as_of_date").distinct().collect()]
        stored = self._read(dates).where(F.col("as_of_date").isin([date_lit(d) for d in dates])) if dates else self._read([])
        return snapshot.select(*S.GOLD_KEY).join(stored.select(*S.GOLD_KEY), S.GOLD_KEY, "left_semi")

    @staticmethod
    def violations(snapshot: DataFrame) -> DataFrame:
        """Per as_of_date: rows, rows with a NULL cell, duplicated keys."""
        any_null = reduce(operator.or_, [F.col(c).isNull() for c in S.GOLD_COLUMNS])
        per_key = snapshot.groupBy(*S.GOLD_KEY).agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(any_null, 1).otherwise(0)).alias("null_rows"))
        return per_key.groupBy("as_of_date").agg(F.sum("n").alias("rows"), F.sum("null_rows").alias("null_rows"),
                                                 F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).alias("dup_keys"))

    def append(self, snapshot: DataFrame, if_stored: str = "error", dates: Sequence | None = None,
               covered: Mapping[str, int] | None = None, honor_deletes: bool = False) -> bool:
        """Check, write and then publish one or more full snapshots.

        The snapshot is computed once and checkpointed to the shared
        checkpoint folder (lineage cut: the checks and the write read the
        checkpoint, and a lost executor does not recompute the snapshot).
        ``dates`` are its runs (those of its rows if not given; a run without
        rows is published as empty). ``if_stored="skip"`` makes a re-run of a
        stored run a no-op (for restarted jobs); the default raises.
        ``covered``, the newest delivery seen per log, and the delete rule go
        into the notes. Returns True when the runs were published.
        """
        if if_stored not in ("error", "skip"):
            raise ValueError(if_stored)
        snap = snapshot.select(*S.GOLD_COLUMNS).checkpoint(eager=True)
        found = {r["as_of_date"]: r for r in self.violations(snap).collect()}  # one row per run
        broken = {str(d): r.asDict() for d, r in found.items() if r["null_rows"] or r["dup_keys"] or d is None}
        if broken:
            raise SnapshotError(f"snapshot breaks GOLD constraints: {broken}")
        runs = sorted({_iso(d) for d in (dates if dates is not None else found)} | {_iso(d) for d in found})
        if set(runs) & set(self.runs.names()):
            return self._refuse(if_stored)
        attempt = uuid.uuid4().hex[:12]
        (snap.withColumn(ATTEMPT, F.lit(attempt)).withColumn("transaction_month", F.trunc("transaction_date", "month"))
             .hint("rebalance", "as_of_date", "transaction_month")
             .write.mode("append").partitionBy("as_of_date", ATTEMPT, "transaction_month").parquet(self.path))
        rows = {_iso(d): int(r["rows"]) for d, r in found.items()}
        made = {"covered": {t: int(n) for t, n in covered.items()} if covered is not None else None, "honor_deletes": honor_deletes}
        published = [self.runs.write(n, {"attempt": attempt, "rows": rows.get(n, 0), **made}) for n in runs]
        return all(published) or self._refuse(if_stored)

    @staticmethod
    def _refuse(if_stored: str) -> bool:
        if if_stored == "skip":
            return False
        raise SnapshotError("snapshot already stored: a run is never rewritten")

    def covered_by(self, as_of_date) -> tuple[dict[str, int], bool] | None:
        """(newest delivery per log, delete rule) of a complete run; None if it was not noted."""
        note = self.note(as_of_date) if self.is_stored(as_of_date) else None
        return (note["covered"], note["honor_deletes"]) if note and note["covered"] is not None else None


def _iso(day) -> str:
    return str(day)[:10]
