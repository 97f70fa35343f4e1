"""Continuous ingest: landing files -> gated, de-duplicated bronze (RAW) store.

``readStream`` over the landing folder with the fixed RAW schema; each
micro-batch goes through the quality gate and is appended to the RAW store
partitioned by ingest month. Appends are idempotent: a retried micro-batch
(or a replayed file) only adds raw keys that are not stored yet, so the
sink stays exactly-once without a transaction log.

Late data: nothing is dropped for arriving late (a watermark-based
de-duplication would discard rows older than the watermark). Arrival time
(``ingestion_ts``), never ``event_ts``, decides when a day is closed: each
micro-batch records the high-water mark of the rows it accepted (a rejected
row's stamp proves nothing), which triggers the daily snapshots (``streaming/snapshots.py``).
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tempora import schemas as S
from tempora.sinks.notes import Notes
from tempora.sinks.raw import append_raw
from tempora.sinks.versioned import FILES


def land(df: DataFrame, landing: str) -> None:
    """Drop a batch of RAW files into a landing folder (an upstream delivery)."""
    df.write.mode("append").options(**FILES).parquet(landing)


def read_landing(spark: SparkSession, landing: str, table: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(S.raw_schema(table))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(landing)


def _progress(spark: SparkSession, bronze: str) -> Notes:
    return Notes(spark, bronze.rstrip("/") + "__progress")


def _note_arrival(spark: SparkSession, bronze: str, until) -> None:
    """Raise the arrival mark of ``bronze`` (the newest note holds it, the last few are kept)."""
    notes, before = _progress(spark, bronze), arrived_until(spark, bronze)
    if before is None or until > before:
        names = notes.names()
        notes.write(f"{(int(names[-1]) if names else 0) + 1:012d}", {"until": until.isoformat()})
        notes.keep_newest(4)


def start_bronze(spark: SparkSession, landing: str, bronze: str, checkpoint: str, table: str,
                 quarantine: str | None, max_files: int | None = None) -> StreamingQuery:
    """Run the landing -> bronze stream over everything available now.

    No event is ever dropped for arriving late. Replays are removed exactly:
    copies inside a micro-batch and copies of stored events by comparing raw
    keys (``quality.judged``, inside ``append_raw``), so a retried micro-batch or a re-delivered file is a no-op.
    Rows that break a rule go to ``quarantine``, one folder per micro-batch;
    with None such a row stops the stream.
    """
    events = read_landing(spark, landing, table, max_files)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        done = append_raw(spark, batch, bronze, table, quarantine, delivery=f"batch-{batch_id}")
        if done["accepted_until"] is not None:  # of the accepted rows, for the snapshot trigger
            _note_arrival(spark, bronze, done["accepted_until"])

    return (events.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def arrived_until(spark: SparkSession, bronze: str):
    """Highest ``ingestion_ts`` ingested so far into ``bronze`` (None if nothing)."""
    found = _progress(spark, bronze).newest()
    return dt.datetime.fromisoformat(found[1]["until"]) if found else None


def bronze_path(root: str, table: str) -> str:
    return os.path.join(root, table)
