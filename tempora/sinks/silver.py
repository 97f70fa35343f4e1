"""SILVER store: which version of an entity counted on which days, merged delivery by delivery.

One row per winning version with the days on which it was the latest known:
``known_from`` (its arrival day) up to, not including, ``known_until`` (NULL:
still). The latest state as of a day is a filter on these two columns, for any
day, without a window or a shuffle. Versions that never won a day are not kept:
no later delivery can make them win.

Each log is a table of whole partitions by the partition column of its key
(``VersionedTable``), and a merge reads and rewrites only the partitions that
the new deliveries touch. Its manifest keeps what the incremental run needs to
find them again without a scan: per purchase partition the range of order days,
and per purchase partition the item partitions whose items ever pointed to it.

A merge rewrites the partitions it touches, so it waits for ``MERGE_EVERY``
deliveries; until then ``with_recent`` lays the deliveries since over the store:
their events join the stored winners in one pick over the partitions asked for.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora import schemas as S
from tempora.functions.rules import date_lit
from tempora.operators.latest import ORDER, _pick, latest_as_of
from tempora.sinks.raw import newest_delivery, raw_path, read_raw
from tempora.sinks.versioned import FILES, VersionedTable

FROM, UNTIL = "known_from", "known_until"
SILVER_LOGS = (S.PURCHASE, S.EXTRA, S.ITEM)
MERGE_EVERY = 16  # deliveries
MIN_BUCKETS, BUCKET_ROWS = 8, 4_000_000
SPREAD_BUCKETS = 64  # up to here each reading task writes to all buckets: a split of 128 MB makes files of 2 MB or more


def silver_schema(table: str) -> T.StructType:
    fields = [f for f in S.raw_schema(table).fields if f.name != _part(table)]
    return T.StructType([*fields, T.StructField(FROM, T.DateType()), T.StructField(UNTIL, T.DateType()), T.StructField(_part(table), T.LongType())])


def _part(table: str) -> str:
    return S.ENTITY_KEYS[table][1]


def _by_part(table: str) -> list[str]:
    """The entity key, partition first."""
    return S.ENTITY_KEYS[table][::-1]


def winning_days(events: DataFrame, table: str) -> DataFrame:
    """Versions with the days they count on, from raw events or from rows that are such already, or both.

    Events ``gathered`` by key stay where they are; others are trimmed to the
    best version per key and arrival day by a partial group limit before their
    shuffle, so a key with very many versions is one row per day and map task.
    """
    keys = _by_part(table)
    best = best_of_days(events, table)
    by = Window.partitionBy(*keys).orderBy(FROM)
    version = F.struct(*ORDER)
    before = F.max(version).over(by.rowsBetween(Window.unboundedPreceding, -1))
    wins = best.withColumn("_before", before).where(F.col("_before").isNull() | (version > F.col("_before"))).drop("_before")
    return wins.withColumn(UNTIL, F.lead(FROM).over(by))


def best_of_days(events: DataFrame, table: str) -> DataFrame:
    """The best version per key and arrival day."""
    cols = [f.name for f in S.raw_schema(table)]
    return _pick(events.select(*cols).withColumn(FROM, F.to_date("ingestion_ts")), [*_by_part(table), FROM])


def gathered(events: DataFrame, table: str) -> DataFrame:
    """Events dealt by ranges of (partition, key): windows over a key and a write by partition need no other exchange."""
    return events.repartitionByRange(*_by_part(table))


def known_on(rows: DataFrame, day) -> DataFrame:
    """The latest state at the end of ``day``."""
    d = date_lit(day)
    return rows.where((F.col(FROM) <= d) & (F.col(UNTIL).isNull() | (F.col(UNTIL) > d)))


class SilverStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.tables = {t: VersionedTable(spark, f"{self.root}/{t}", silver_schema(t), _part(t)) for t in SILVER_LOGS}
        self.recent: dict[str, DataFrame] = {}
        self._kept: dict[str, dict] = {}

    def covered(self, table: str) -> int:
        """Newest delivery merged; -1 before the first."""
        return self.tables[table].manifest()["kept"].get("covered", -1)

    def _since(self, raw_root: str, table: str, done: int, until: int) -> DataFrame:
        fresh = read_raw(self.spark, raw_path(raw_root, table), table, with_partition=True)
        return fresh.where((F.col("delivery_id") > F.lit(done).cast("long")) & (F.col("delivery_id") <= F.lit(until).cast("long")))

    def refresh(self, raw_root: str, until: Mapping[str, int] | None = None, every: int = 1) -> dict[str, int]:
        """Merge the complete deliveries not merged yet (up to ``until`` per log) where there are ``every`` or more, or none
        is merged; what is covered now."""
        out = {}
        for table in SILVER_LOGS:
            newest = until[table] if until else newest_delivery(self.spark, raw_path(raw_root, table))
            done = self.covered(table)
            if done < 0 or newest - done >= every:
                self.merge(table, self._since(raw_root, table, done, newest), newest)
                done = max(newest, done)
            out[table] = done
        return out

    def with_recent(self, raw_root: str, until: Mapping[str, int]) -> SilverStore:
        """The store with the deliveries that it has not merged, up to ``until``, laid over it (few: they are kept checkpointed)."""
        view = SilverStore(self.spark, self.root)
        for table in SILVER_LOGS:
            done = self.covered(table)
            if until[table] > done:
                cols = [f.name for f in S.raw_schema(table)]
                view.recent[table] = self._since(raw_root, table, done, until[table]).select(*cols).checkpoint()
        return view

    def merge(self, table: str, fresh: DataFrame, covered: int) -> None:
        """Merge raw events; partitions without any keep their version. Merging events again changes nothing."""
        store, part = self.tables[table], _part(table)
        manifest = store.manifest()
        parts, crowded = self._touched(fresh, table)
        cols = [f.name for f in S.raw_schema(table)]
        fresh_rows = best_of_days(fresh, table) if crowded else fresh
        rows = winning_days(gathered(store.read(parts, manifest).select(*cols).unionByName(fresh_rows.select(*cols)), table), table)
        kept = {**manifest["kept"], "covered": covered}
        now = store.replace(rows, parts, kept | self._index(table, fresh, kept), manifest, S.ENTITY_KEYS[table], dealt=True)
        if now["number"] % 8 == 0:
            store.vacuum()

    def _touched(self, fresh: DataFrame, table: str) -> tuple[list, bool]:
        """Partitions of new events, and whether over a tenth of the events are beaten on their own day (about)."""
        day = F.xxhash64(*S.ENTITY_KEYS[table], F.to_date("ingestion_ts"))
        found = fresh.groupBy(_part(table)).agg(F.count(F.lit(1)), F.approx_count_distinct(day, 0.02)).collect()
        return [r[0] for r in found], sum(max(n - best, 0) for _, n, best in found) * 10 > sum(n for _, n, _ in found)

    def _index(self, table: str, fresh: DataFrame, kept: dict) -> dict:
        """What the manifest remembers per partition; grown by the new events alone."""
        if table == S.PURCHASE:
            days = dict(kept.get("days", {}))
            found = fresh.groupBy(_part(table)).agg(F.min("order_date"), F.max("order_date"), F.max(F.col("order_date").isNull())).collect()
            for part, lo, hi, null in found:
                old = days.get(str(part), [None, None, False])
                known = [x for x in (old[0], old[1], lo and lo.isoformat(), hi and hi.isoformat()) if x]
                days[str(part)] = [min(known, default=None), max(known, default=None), bool(null) or old[2]]
            return {"days": days}
        if table == S.ITEM:
            links = {k: set(v) for k, v in kept.get("links", {}).items()}
            pairs = fresh.where("purchase_id IS NOT NULL AND purchase_partition IS NOT NULL").select("purchase_partition", _part(table)).distinct()
            for purchase_part, item_part in pairs.collect():  # pairs of partitions
                links.setdefault(str(purchase_part), set()).add(item_part)
            return {"links": {k: sorted(v) for k, v in links.items()}}
        return {}

    # -- tables for joins ------------------------------------------------------------
    def publish_bucketed(self, prefix: str, buckets: int | None = None) -> dict[str, str]:
        """The merged versions as catalog tables bucketed and sorted by purchase key; their names by log.

        Items are bucketed by the purchase they point to, so latest states of
        the three logs join, and items add up, without an exchange on that key.
        ``buckets`` should leave a bucket's newest states within a task's memory;
        left out, it grows with the rows stored. A task that reads silver writes
        a file to each bucket it has rows for, so there is no exchange here
        either; rows are dealt by bucket first only where those files would be
        small for the number of buckets.
        """
        if buckets is None:
            most = max(self.tables[t].read().count() for t in SILVER_LOGS)  # from the footers
            buckets = max(MIN_BUCKETS, -(-most // BUCKET_ROWS))
        names = {}
        for table in SILVER_LOGS:
            names[table] = f"{prefix}_{table}"
            rows = self.tables[table].read()
            rows = rows.repartition(buckets, *S.PURCHASE_KEY) if buckets > SPREAD_BUCKETS else rows
            (rows.write.bucketBy(buckets, *S.PURCHASE_KEY).sortBy(*S.PURCHASE_KEY)
                 .options(**FILES).option("path", f"{self.root}/bucketed/{prefix}/{table}").mode("overwrite").saveAsTable(names[table]))
        return names

    # -- reads ---------------------------------------------------------------------
    def versions(self, table: str, parts: Iterable | None = None) -> DataFrame:
        """Raw columns of all versions that ever won, and of all recent events."""
        cols = [f.name for f in S.raw_schema(table)]
        rows = self.tables[table].read(parts).select(*cols)
        return rows.unionByName(self._recent_in(table, parts)) if table in self.recent else rows

    def _recent_in(self, table: str, parts: Iterable | None) -> DataFrame:
        rows = self.recent[table]
        return rows if parts is None else rows.where(F.col(_part(table)).isin([int(p) for p in parts]))

    def state(self, table: str, day, parts: Iterable | None = None) -> DataFrame:
        """The latest state at the end of ``day``: a scan and a filter (and a pick, where recent events lie over the store)."""
        cols = [f.name for f in S.raw_schema(table)]
        stored = known_on(self.tables[table].read(parts), day).select(*cols)
        if table not in self.recent:
            return stored
        seen = self._recent_in(table, parts).where(F.to_date("ingestion_ts") <= date_lit(day))
        return latest_as_of(stored.unionByName(seen), S.ENTITY_KEYS[table])

    def _remembered(self, table: str) -> dict:
        if table not in self._kept:
            kept = self.tables[table].manifest()["kept"]
            self._kept[table] = kept | self._index(table, self.recent[table], kept) if table in self.recent else kept
        return self._kept[table] if self.recent else self.tables[table].manifest()["kept"]

    def parts_with(self, days: Iterable[dt.date | None]) -> list[str]:
        """Purchase partitions that may hold a version with one of the order days (None: a NULL day)."""
        days = list(days)
        isos, null = [d.isoformat() for d in days if d is not None], None in days
        ranges = self._remembered(S.PURCHASE).get("days", {})
        return [p for p, (lo, hi, has_null) in ranges.items() if (null and has_null) or (lo is not None and any(lo <= d <= hi for d in isos))]

    def item_parts(self, purchase_parts: Iterable) -> list:
        """Item partitions of which an item ever pointed into the given purchase partitions."""
        links = self._remembered(S.ITEM).get("links", {})
        return sorted({i for p in purchase_parts for i in links.get(str(p), [])})
