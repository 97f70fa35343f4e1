"""RAW store: append-only CDC events, partitioned by ingest month; deliveries first, compacted later.

Two areas make one table. New deliveries lie in ``<path>/ingest_month=M/delivery_id=N/``;
every ``COMPACT_EVERY`` deliveries those are merged into ``<path>__base``, which
holds one version per ingest month with the delivery as a column, sorted by
groups of deliveries and then by key, so that row groups are skipped by either.
Folders and files therefore do not grow with the number of deliveries or
micro-batches. A cutoff prunes whole month folders and, inside the month, row
groups by their statistics; "what entered the store since" prunes delivery
folders and row groups, whatever stamps the events carry.

A delivery counts once its note (``<path>__deliveries/N``) is there, written
after its rows: what a writer that died has left is invisible, and the next
delivery, which takes the same number, removes it. Each log has one appender at
a time, which also compacts.

An append is gated (domain, NOT NULL), checked for conflicts (one raw key with
different contents) and de-duplicated on the raw key, so a replayed delivery
is a no-op. A delivery that breaks a rule is refused as a whole, unless the
caller names a quarantine for the offending rows.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora import schemas as S
from tempora.functions.rules import date_lit
from tempora.operators import quality
from tempora.session import ensure_checkpoint_dir, path_exists
from tempora.sinks.notes import Notes, delete, folders
from tempora.sinks.versioned import FILES, VersionedTable, values_of

PARTITION_COLUMN = "ingest_month"
DELIVERY_COLUMN = "delivery_id"
COMPACT_EVERY = 32  # deliveries
NOTES_KEPT = 8


class DeliveryError(ValueError):
    """A delivery breaks a RAW constraint and no quarantine was named."""


def stored_schema(table: str) -> T.StructType:
    return T.StructType(list(S.raw_schema(table, derived=True).fields)
                        + [T.StructField(PARTITION_COLUMN, T.DateType(), True), T.StructField(DELIVERY_COLUMN, T.LongType(), True)])


def _base(spark: SparkSession, path: str, table: str) -> VersionedTable:
    return VersionedTable(spark, path.rstrip("/") + "__base", stored_schema(table), PARTITION_COLUMN)


def _notes(spark: SparkSession, path: str) -> Notes:
    return Notes(spark, path.rstrip("/") + "__deliveries")


def newest_delivery(spark: SparkSession, path: str) -> int:
    """Number of the newest complete delivery (a listing); 0 before the first."""
    names = _notes(spark, path).names()
    return int(names[-1]) if names else 0


def read_raw(spark: SparkSession, path: str, table: str, with_partition: bool = False) -> DataFrame:
    """Scan a RAW table with its fixed schema (no inference): compacted months and complete deliveries after them."""
    base = _base(spark, path, table)
    manifest = base.manifest()
    newest = F.lit(newest_delivery(spark, path)).cast("long")
    recent = spark.read.schema(stored_schema(table)).parquet(path).where(F.col(DELIVERY_COLUMN) <= newest)
    if manifest["number"]:
        recent = recent.where(F.col(DELIVERY_COLUMN) > F.lit(manifest["kept"]["covered"]).cast("long"))
        recent = base.read(manifest=manifest).unionByName(recent)
    return recent if with_partition else recent.drop(PARTITION_COLUMN, DELIVERY_COLUMN)


def write_raw(df: DataFrame, path: str, delivery_id: int = 0, sort: Sequence[str] = ()) -> None:
    """Append rows that already carry ``transaction_date`` (the ingest day) as one delivery, without noting it.

    The ``rebalance`` hint clusters rows by ingest month before the write (one
    shuffle) and lets AQE size the writer tasks: small months are coalesced
    into few files, a hot month is split over several tasks. Rows dealt by
    month already stay where they are: with ``sort`` they are sorted by it instead.
    """
    rows = df.withColumn(PARTITION_COLUMN, F.trunc("transaction_date", "month"))
    rows = rows if sort else rows.hint("rebalance", PARTITION_COLUMN)
    rows = rows.withColumn(DELIVERY_COLUMN, F.lit(delivery_id).cast("long"))
    if sort:
        rows = rows.sortWithinPartitions(PARTITION_COLUMN, DELIVERY_COLUMN, *sort)
    rows.write.mode("append").partitionBy(PARTITION_COLUMN, DELIVERY_COLUMN).options(**FILES).parquet(path)


def _drop_deliveries(spark: SparkSession, path: str, gone: Callable[[int], bool]) -> None:
    """Delete the folders of the deliveries for which ``gone`` holds (a listing per month)."""
    for month in folders(spark, path):
        if month.startswith(f"{PARTITION_COLUMN}="):
            for name in folders(spark, f"{path}/{month}"):
                if name.startswith(f"{DELIVERY_COLUMN}=") and gone(int(name.split("=", 1)[1])):
                    delete(spark, f"{path}/{month}/{name}")


def _deliver(spark: SparkSession, df: DataFrame, path: str, table: str) -> int:
    """Write a delivery (rows dealt by month), then note it. Leftovers of one that died under this number go first."""
    number = newest_delivery(spark, path) + 1
    _drop_deliveries(spark, path, lambda n: n >= number)
    write_raw(df, path, number, S.RAW_KEYS[table])
    if not _notes(spark, path).write(f"{number:012d}", {}):
        raise DeliveryError(f"{path}: another writer has appended delivery {number}")
    _notes(spark, path).keep_newest(NOTES_KEPT)
    return number


def compact_raw(spark: SparkSession, path: str, table: str, every: int = 1) -> bool:
    """Merge the complete deliveries since the last compaction into the base, if there are ``every`` of them or more.

    Months without new rows are left as they are. The folders merged here are
    deleted by the next compaction, so reads that have begun find them.
    """
    base = _base(spark, path, table)
    manifest, newest = base.manifest(), newest_delivery(spark, path)
    covered = manifest["kept"].get("covered", -1)
    if newest - max(covered, 0) < every:
        return False
    recent = spark.read.schema(stored_schema(table)).parquet(path).where(
        (F.col(DELIVERY_COLUMN) > F.lit(covered).cast("long")) & (F.col(DELIVERY_COLUMN) <= F.lit(newest).cast("long")))
    months = values_of(recent, PARTITION_COLUMN)
    rows = base.read(months, manifest).unionByName(recent)
    # the group of deliveries stands for the delivery in the order, so that keys have runs as long as a row group
    base.replace(rows, months, {"covered": newest}, manifest, [F.floor(F.col(DELIVERY_COLUMN) / COMPACT_EVERY), *S.RAW_KEYS[table]])
    base.vacuum()
    _drop_deliveries(spark, path, lambda n: n <= covered)
    return True


def months_of(df: DataFrame) -> list:
    """Ingest months of a batch (a delivery has few)."""
    return [r[0] for r in df.select(F.trunc("transaction_date", "month").alias("m")).distinct().where("m IS NOT NULL").collect()]


def in_months(stored: DataFrame, months: Sequence) -> DataFrame:
    """The stored rows of the given months (literals: other folders are not read)."""
    return stored.where(F.col(PARTITION_COLUMN).isin([date_lit(m) for m in months])) if months else stored.limit(0)


def _counted(judged: DataFrame) -> tuple[DataFrame, dict]:
    """The rows as a checkpoint, and how many are new and clash, counted in the pass that writes it."""
    counts = Observation()
    judged = judged.observe(counts, F.count_if(~F.col("clash")).alias("new"), F.count_if("clash").alias("clashing")).checkpoint()
    return judged, counts.get


def append_raw(spark: SparkSession, batch: DataFrame, path: str, table: str,
               quarantine: str | None = None, delivery: str | None = None) -> dict:
    """Gate, check, de-duplicate and append one delivery; return its counts.

    Rows that break a rule, and rows whose raw key comes with different
    contents (inside the delivery or against what is stored), are refused:
    without ``quarantine`` the whole delivery is, and nothing is written; with
    it those rows go there with their reason, the rest is appended. The
    quarantine holds one folder per delivery, named ``delivery`` or by the
    rows' contents, and a repeated delivery overwrites its own folder. Rows
    stored already are skipped. Only the months in the delivery are compared
    with the store, and of those the rows stamped between its oldest and newest
    arrival (the stamp is part of the key). The gates' counts are observed in
    the passes that write the rows: a sound delivery is three passes (tagged
    rows, new rows, the store's files) and one exchange (``quality.judged``).
    """
    ensure_checkpoint_dir(spark)
    tagged = quality.tag(batch, table)
    own_day = "transaction_date" in tagged.columns
    if not own_day:
        tagged = tagged.withColumn("transaction_date", F.to_date("ingestion_ts"))
    cols = [f.name for f in S.raw_schema(table, derived=True)]
    tagged, gate = quality.observed(tagged.select(*cols, "reject_reason"), table)
    tagged = tagged.checkpoint()  # read several times below
    seen = gate.get
    sound = tagged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    stored = None
    if path_exists(spark, path):
        months = [date.fromisoformat(m) for m in seen["months"].split(",") if m]
        stored = in_months(read_raw(spark, path, table, with_partition=True), months)
        since, until = (F.lit(seen[x]).cast("timestamp_ntz") for x in ("since", "until"))
        stored = stored.where((F.col("ingestion_ts") >= since) & (F.col("ingestion_ts") <= until))
    new, counts = _counted(quality.judged(sound, stored, table, seen["keys"] < seen["sound"] / 2, own_day))
    rejected = tagged.where(F.col("reject_reason").isNotNull())
    found, reached = (seen["rejected"], seen["rejected_hash"]), seen["reached"]
    if counts["clashing"]:
        clashes = new.where("clash")
        conflicting = quality.matching(sound, clashes, table, "left_semi").withColumn("reject_reason", F.lit("key conflict"))
        rejected = rejected.unionByName(conflicting)
        sound = quality.matching(sound, clashes, table, "left_anti")
        found = rejected.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*rejected.columns).cast("decimal(38,0)"))).first()
        reached = sound.agg(F.max("ingestion_ts")).first()[0]
    if found[0] and not quarantine:
        reasons = {r[0]: r[1] for r in rejected.groupBy("reject_reason").count().collect()}
        raise DeliveryError(f"{table}: delivery refused, {found[0]} rows break a rule: {reasons}")
    if counts["new"]:
        _deliver(spark, new.where("NOT clash").drop("clash"), path, table)
        compact_raw(spark, path, table, COMPACT_EVERY)
    if found[0]:
        rejected.write.mode("overwrite").parquet(os.path.join(quarantine, f"delivery={delivery or format(abs(int(found[1])), 'x')}"))
    return {"path": path, "accepted": counts["new"], "rejected": found[0], "accepted_until": reached}


def raw_path(root: str, table: str) -> str:
    return os.path.join(root, table)
