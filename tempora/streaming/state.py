"""Latest state per entity as of a day, kept by a stream with a watermark on arrival.

Two streams and a table of states, all under one root:

* ``route``: landing files are split by the arrival mark of the batches before:
  rows of days that are closed already go to the late table, the others on to
  the second stream. So no row is ever lost to Spark's watermark.
* ``close``: the winner per entity and arrival day, an aggregate under Spark's
  event-time watermark on ``ingestion_ts`` (arrival, never ``event_ts``, which
  only orders versions). It emits a day's winners once, when the watermark
  passes the day's end, and then evicts them: the state store holds open days.
* states: the state as of a day is the one before it, the winners of the days
  between, and the late rows since. Once it is published, the day and late rows
  that it holds are dropped, so what is kept between states does not grow.

``max(struct(event_ts, ingestion_ts, payload...))`` per key is exactly the batch
pick, (key, event_ts, ingestion_ts) being the raw key; a maximum of maxima is
the same maximum, so replays and retried batches change nothing.

Spark's watermarks take no zone-less timestamps: arrival is carried as the
instant that reads the same in UTC, whatever the session's zone.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tempora import schemas as S
from tempora.functions.rules import RunParams, date_lit
from tempora.operators import quality
from tempora.operators.latest import latest_as_of
from tempora.sinks.notes import Notes, delete
from tempora.streaming.ingest import read_landing

ARRIVED, DAY = "arrived", "arrival_day"
EPOCH = dt.datetime(1970, 1, 1)


def arrival_instant(col: str = "ingestion_ts") -> Column:
    """A zone-less timestamp as the instant of the same reading in UTC."""
    return F.timestamp_micros(F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {col})"))


def day_winners(events: DataFrame, keys: Sequence[str], lateness: dt.timedelta) -> DataFrame:
    """Streaming DataFrame of (keys, best version) per arrival day, for append mode: out once a day is closed."""
    payload = [c for c in events.columns if c not in (*keys, "event_ts", "ingestion_ts")]
    winner = F.max(F.struct("event_ts", "ingestion_ts", *payload)).alias("_w")
    marked = events.withColumn(ARRIVED, arrival_instant()).withWatermark(ARRIVED, f"{int(lateness.total_seconds() * 1000)} milliseconds")
    days = marked.groupBy(F.window(ARRIVED, "1 day"), *keys).agg(winner)
    return days.select(*keys, *[F.col("_w")[c].alias(c) for c in payload], F.col("_w.event_ts").alias("event_ts"), F.col("_w.ingestion_ts").alias("ingestion_ts"))


class Batches:
    """Rows written batch by batch, each published by a note with its last day; a repeated batch replaces itself."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.notes = spark, path, Notes(spark, path + "__batches")

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows = rows.withColumn(DAY, F.to_date("ingestion_ts")).persist()
        last = rows.agg(F.max(DAY)).first()[0]
        if last is not None:
            rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
            self.notes.write(f"{batch_id:012d}", {"last_day": last.isoformat()})
        rows.unpersist()

    def newest(self) -> int:
        names = self.notes.names()
        return int(names[-1]) if names else -1

    def read(self) -> DataFrame | None:
        names = self.notes.names()
        paths = [f"{self.path}/batch={int(n)}" for n in names]
        return self.spark.read.option("basePath", self.path).parquet(*paths) if paths else None

    def drop_until(self, day: dt.date, batch: int | None = None) -> None:
        """Drop the batches that end by ``day`` (among those up to ``batch``)."""
        for name in self.notes.names():
            if self.notes.read(name)["last_day"] <= day.isoformat() and (batch is None or int(name) <= batch):
                delete(self.spark, f"{self.notes.path}/{name}")
                delete(self.spark, f"{self.path}/batch={int(name)}")


class StateStream:
    """The streams and tables of one log under ``root``."""

    def __init__(self, spark: SparkSession, table: str, root: str, lateness: dt.timedelta = dt.timedelta(0)):
        self.spark, self.table, self.root, self.lateness = spark, table, root.rstrip("/"), lateness
        self.keys = S.ENTITY_KEYS[table]
        self.late, self.days = Batches(spark, f"{self.root}/late"), Batches(spark, f"{self.root}/days")
        self.marks, self.closed = Notes(spark, f"{self.root}/marks"), Notes(spark, f"{self.root}/closed")
        self.runs = Notes(spark, f"{self.root}/states__runs")

    # -- streams ---------------------------------------------------------------
    def route(self, landing: str, max_files: int | None = None) -> StreamingQuery:
        """Split what has landed into timely rows (handed on as files) and late ones; rows that break a rule go to neither."""
        timely = f"{self.root}/timely"
        self.spark.createDataFrame([], S.raw_schema(self.table)).write.mode("append").parquet(timely)  # the next stream needs the folder

        def split(batch: DataFrame, batch_id: int) -> None:
            earlier = [n for n in self.marks.names() if int(n) < batch_id]  # a repeated batch is split as the first time
            before = self.marks.read(earlier[-1])["until"] if earlier else None
            rows = quality.split(batch, self.table)[0].persist()
            closing = F.date_add(F.to_date("ingestion_ts"), 1).cast("timestamp_ntz")
            behind = F.lit(False) if before is None else \
                closing <= F.lit((dt.datetime.fromisoformat(before) - self.lateness).isoformat(sep=" ")).cast("timestamp_ntz")
            self.late.write(rows.where(behind), batch_id)
            rows.where(~behind).write.mode("overwrite").parquet(f"{timely}/batch-{batch_id}")
            top = rows.agg(F.max("ingestion_ts")).first()[0]
            rows.unpersist()
            until = max((x for x in (before, top and top.isoformat()) if x), default=None)
            if until is not None:
                self.marks.write(f"{batch_id:012d}", {"until": until})
                self.marks.keep_newest(4)

        return (read_landing(self.spark, landing, self.table, max_files).writeStream.foreachBatch(split)
                .option("checkpointLocation", f"{self.root}/route-checkpoint").trigger(availableNow=True).start())

    def close_days(self, max_files: int | None = None) -> StreamingQuery:
        """Emit the winners of closed days; files that have been read are deleted as the stream goes on."""
        reader = self.spark.readStream.schema(S.raw_schema(self.table)).option("recursiveFileLookup", "true").option("cleanSource", "delete")
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        winners = day_winners(reader.parquet(f"{self.root}/timely"), self.keys, self.lateness)
        return (winners.writeStream.outputMode("append").foreachBatch(lambda rows, batch_id: self.days.write(rows, batch_id))
                .option("checkpointLocation", f"{self.root}/days-checkpoint").trigger(availableNow=True).start())

    def advance(self, landing: str, max_files: int | None = None) -> dict | None:
        """Run both streams over everything that has landed; the progress of the second (None if it had nothing to do)."""
        self.route(landing, max_files).awaitTermination()
        query = self.close_days()
        query.awaitTermination()
        progress = query.lastProgress
        mark = (progress or {}).get("eventTime", {}).get("watermark")
        if mark:
            closed = self.closed.names()
            self.closed.write(f"{(int(closed[-1]) if closed else 0) + 1:012d}", {"until": mark.rstrip("Z")})
            self.closed.keep_newest(4)
        return progress

    def watermark(self) -> dt.datetime | None:
        """Arrivals before it have been emitted or are in the late table."""
        found = self.closed.newest()
        mark = dt.datetime.fromisoformat(found[1]["until"]) if found else None
        return mark if mark and mark > EPOCH else None

    # -- states ------------------------------------------------------------------
    def emit_due(self, schedule: Iterable) -> list[RunParams]:
        """Publish the state as of every scheduled day that the watermark has closed; in date order, each from the one before.

        A day at or before the newest state cannot be made up for: what it
        would need has been folded into that state.
        """
        mark, done = self.watermark(), self.runs.names()
        runs = sorted((RunParams.for_day(d) for d in schedule), key=lambda r: r.cutoff_ts)
        due = [r for r in runs if mark is not None and r.cutoff_ts <= mark and (not done or r.as_of_date.isoformat() > done[-1])]
        for run in due:
            self._publish(run)
        return due

    def _publish(self, run: RunParams) -> None:
        found, newest_late = self.runs.newest(), self.late.newest()
        upto = F.col(DAY) <= date_lit(run.as_of_date)
        parts, days, late = [], self.days.read(), self.late.read()
        if found:
            since = F.col(DAY) > date_lit(found[0])
            parts.append(self.as_of(found[0]))
            days = days.where(since) if days is not None else None
            late = late.where(since | (F.col("batch") > F.lit(found[1]["late"]))) if late is not None else None
        parts += [p.where(upto).drop("batch", DAY) for p in (days, late) if p is not None]
        attempt = uuid.uuid4().hex[:12]
        rows = reduce(lambda a, b: a.unionByName(b), parts) if parts else self.spark.createDataFrame([], S.raw_schema(self.table))
        latest_as_of(rows, self.keys).write.parquet(f"{self.root}/states/as_of_date={run.as_of_date}/attempt={attempt}")
        if self.runs.write(run.as_of_date.isoformat(), {"attempt": attempt, "late": newest_late}):
            self.days.drop_until(run.as_of_date)
            self.late.drop_until(run.as_of_date, newest_late)

    def as_of(self, as_of_date) -> DataFrame:
        """The published state of one day (one folder is read)."""
        day = str(as_of_date)[:10]
        return self.spark.read.parquet(f"{self.root}/states/as_of_date={day}/attempt={self.runs.read(day)['attempt']}")

    def current(self) -> DataFrame:
        """The state now: the newest published one, what came in since, and the open days out of the stream's state store."""
        newest = self.runs.names()[-1:]
        parts = [self.as_of(d) for d in newest] + [p.drop("batch", DAY) for p in (self.days.read(), self.late.read()) if p is not None]
        store = self.spark.read.format("statestore").load(f"{self.root}/days-checkpoint")
        winner = store.schema["value"].dataType.fields[0].name
        cols = [f.name for f in S.raw_schema(self.table)]
        open_days = store.select(*[(F.col("key")[k] if k in self.keys else F.col("value")[winner][k]).alias(k) for k in cols])
        return latest_as_of(reduce(lambda a, b: a.unionByName(b), [*[p.select(*cols) for p in parts], open_days]), self.keys)
