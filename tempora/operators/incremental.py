"""Incremental run: recompute only the days touched since the previous run,
and still write a FULL new snapshot, equal to what a full run would write.

The current view reads only the newest snapshot, so every snapshot must be
complete: untouched days are carried forward from the previous snapshot
under the new ``as_of_date`` / ``run_id``.

Arrival. An event is new to a run if the previous run did not see it: it is
stamped at or after the previous cutoff, or it entered the store with a
delivery that the previous run did not cover (``covered``: the newest delivery
per log at that run). The second rule catches events delivered late with an
old stamp. It needs the store's ``delivery_id``; logs without one are taken
as complete at every moment.

Touched days. A purchase key is changed when any of its purchase or extra
events, or any event of an item that points to it, is new. The days touched
are the order days of every known version of a changed purchase: a superset
of the day it counted in before and the day it counts in now (a day may move,
an item may move between purchases). A NULL order day is a day like any other
here, so a snapshot that a full run would refuse is refused as well.

Two ways. From the stored silver (``incremental_from``, ``impacted_dates_from``):
arrivals and the partitions they touch are read, latest states are filters.
From logs alone (``incremental_snapshot``, ``impacted_dates``), where no store
is kept, the rest of this text.

Recompute. Events are restricted by WHOLE keys before the pick (a purchase
with any version on a touched day, items with any version pointing to such
a purchase), never event by event, then picked as usual.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora import schemas as S
from tempora.functions.rules import RunParams, date_lit, known_before, ts_lit
from tempora.operators.gmv import PK, aggregate_snapshot, eligible_at, eligible_purchases, items_by_purchase
from tempora.operators.latest import prune_ingest_days
from tempora.schemas import GOLD_COLUMNS
from tempora.session import ensure_checkpoint_dir
from tempora.sinks.silver import SilverStore
from tempora.sinks.versioned import values_of

DAY = "transaction_date"


def _known(df: DataFrame, cutoff) -> DataFrame:
    return prune_ingest_days(df, cutoff).where(known_before(cutoff))


def new_events(df: DataFrame, prev_cutoff, new_cutoff, covered: int | None = None) -> DataFrame:
    """Events known at the new cutoff that the previous run did not see."""
    new = F.col("ingestion_ts") >= ts_lit(prev_cutoff)
    if "ingest_month" in df.columns:
        month = F.col("ingest_month") >= F.trunc(ts_lit(prev_cutoff).cast("date"), "month")
        new = new & month
    if covered is not None and "delivery_id" in df.columns:
        new = new | (F.col("delivery_id") > covered)
    return _known(df, new_cutoff).where(new)


def changed_purchases(logs: Mapping[str, DataFrame], prev: RunParams, new: RunParams,
                      covered: Mapping[str, int] | None = None) -> DataFrame:
    """Distinct purchase keys changed by events that are new since ``prev``."""
    fresh = {t: new_events(logs[t], prev.cutoff_ts, new.cutoff_ts, (covered or {}).get(t)) for t in (S.PURCHASE, S.EXTRA, S.ITEM)}
    item_key = S.ENTITY_KEYS[S.ITEM]
    # Every purchase any known version of a touched item points to (old and new winner included).
    i = (_known(logs[S.ITEM], new.cutoff_ts)
         .join(fresh[S.ITEM].select(*item_key).distinct(), item_key, "left_semi")
         .where(F.col("purchase_id").isNotNull() & F.col("purchase_partition").isNotNull())
         .select(*PK))
    return fresh[S.PURCHASE].select(*PK).unionByName(fresh[S.EXTRA].select(*PK)).unionByName(i).distinct()


def touched_days(logs: Mapping[str, DataFrame], changed: DataFrame, new: RunParams) -> DataFrame:
    """Order days of every known version of the changed purchases (NULL included)."""
    return (_known(logs[S.PURCHASE], new.cutoff_ts).join(changed, PK, "left_semi")
            .select(F.col("order_date").alias(DAY)).distinct())


def whole_keys(logs: Mapping[str, DataFrame], keys: DataFrame, cutoff) -> dict[str, DataFrame]:
    """Logs cut down to the given purchases: all their versions, and all versions of items that ever pointed to them."""
    item_key = S.ENTITY_KEYS[S.ITEM]
    items = _known(logs[S.ITEM], cutoff)
    item_keys = items.join(keys, PK, "left_semi").select(*item_key).distinct()
    return {
        S.PURCHASE: _known(logs[S.PURCHASE], cutoff).join(keys, PK, "left_semi"),
        S.EXTRA: _known(logs[S.EXTRA], cutoff).join(keys, PK, "left_semi"),
        S.ITEM: items.join(item_keys, item_key, "left_semi"),
    }


def impacted_dates(logs: Mapping[str, DataFrame], prev: RunParams, new: RunParams) -> DataFrame:
    """Order days on which a changed purchase counts at either cutoff."""
    ensure_checkpoint_dir(logs[S.PURCHASE].sparkSession)
    keys = changed_purchases(logs, prev, new).checkpoint()
    small = whole_keys(logs, keys, new.cutoff_ts)
    # an item that moved here may have siblings elsewhere, so count only the changed purchases themselves
    counted = [eligible_at(small, run.cutoff_ts).join(keys, PK, "left_semi").select(DAY) for run in (prev, new)]
    return counted[0].unionByName(counted[1]).distinct()


def restrict_to_days(logs: Mapping[str, DataFrame], days: DataFrame, cutoff) -> dict[str, DataFrame]:
    """Logs cut down to whole keys that can reach one of ``days``.

    The key set feeds three semi joins; it is checkpointed once (shared
    checkpoint folder) instead of rescanning the purchase log three times.
    """
    purchases = _known(logs[S.PURCHASE], cutoff)
    keys = (purchases.join(days, purchases.order_date.eqNullSafe(days[DAY]), "left_semi")
            .select(*PK).distinct().checkpoint(eager=True))
    return whole_keys(logs, keys, cutoff)


def changed_in_silver(silver: SilverStore, fresh: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct purchase keys that new events can change: their own, and all that a touched item ever counted for.

    ``fresh`` are the new events per log; of the store, only the item
    partitions they name are read (the index item -> purchases).
    """
    item_key = S.ENTITY_KEYS[S.ITEM]
    touched = fresh[S.ITEM].select(*item_key, *PK).checkpoint()
    referred = silver.versions(S.ITEM, values_of(touched, item_key[1])).join(touched.select(*item_key).distinct(), item_key, "left_semi").select(*PK)
    items = referred.unionByName(touched.select(*PK)).where(F.col("purchase_id").isNotNull() & F.col("purchase_partition").isNotNull())
    return fresh[S.PURCHASE].select(*PK).unionByName(fresh[S.EXTRA].select(*PK)).unionByName(items).distinct()


def _counted_on(silver: SilverStore, day, parts, only: DataFrame | None = None) -> DataFrame:
    """Eligible purchases of the given purchase partitions at the end of ``day`` (of the keys in ``only``)."""
    p = silver.state(S.PURCHASE, day, parts)
    if only is not None:
        p = p.join(only, PK, "left_semi")
    items = items_by_purchase(silver.state(S.ITEM, day, silver.item_parts(parts)))
    return eligible_purchases(p, silver.state(S.EXTRA, day, parts), items)


def impacted_dates_from(silver: SilverStore, fresh: Mapping[str, DataFrame], prev: RunParams, new: RunParams) -> DataFrame:
    """``impacted_dates`` from the stored silver: arrivals and the partitions they touch are read, no whole log."""
    keys = changed_in_silver(silver, fresh).checkpoint()
    parts = values_of(keys, PK[1])
    counted = [_counted_on(silver, run.as_of_date, parts, keys).select(DAY) for run in (prev, new)]
    return counted[0].unionByName(counted[1]).distinct()


def incremental_from(silver: SilverStore, fresh: Mapping[str, DataFrame], previous: DataFrame, new: RunParams) -> DataFrame:
    """Full snapshot for ``new`` from the stored silver, the new events and the previous snapshot.

    Read are the new events, the partitions they touch, and the purchase
    partitions that may hold a touched day with the item partitions linked to
    them; every latest state is a filter. The touched days, at most one per
    calendar day, come to the driver to choose partitions.
    """
    keys = changed_in_silver(silver, fresh).checkpoint()
    days = silver.versions(S.PURCHASE, values_of(keys, PK[1])).join(keys, PK, "left_semi").select(F.col("order_date").alias(DAY)).distinct().checkpoint()
    parts = silver.parts_with(r[0] for r in days.collect())
    again = _counted_on(silver, new.as_of_date, parts)
    return _carry_forward(again, previous, days, new)


def _carry_forward(again: DataFrame, previous: DataFrame, days: DataFrame, new: RunParams) -> DataFrame:
    """The touched days recomputed, the others from the previous snapshot."""
    out = ["transaction_date", "subsidiary", date_lit(new.as_of_date).alias("as_of_date"),
           "gmv_amount", "purchases_count", "source_max_ingestion_ts", F.lit(new.run_id).alias("run_id")]
    fresh = aggregate_snapshot(again.join(days, again[DAY].eqNullSafe(days[DAY]), "left_semi")).select(*out)
    return fresh.unionByName(previous.join(days, DAY, "left_anti").select(*out)).select(*GOLD_COLUMNS)


def incremental_snapshot(logs: Mapping[str, DataFrame], previous: DataFrame, prev: RunParams, new: RunParams,
                         covered: Mapping[str, int] | None = None) -> DataFrame:
    """Full snapshot for ``new`` from the stored snapshot of ``prev``, made under the same delete rule.

    ``covered`` is the newest delivery per log that ``prev`` saw. The touched
    days (at most one row per calendar day) are computed once and
    checkpointed: they steer the restriction, the recompute and the
    carry-forward.
    """
    ensure_checkpoint_dir(previous.sparkSession)
    days = touched_days(logs, changed_purchases(logs, prev, new, covered), new).checkpoint(eager=True)
    small = restrict_to_days(logs, days, new.cutoff_ts)
    return _carry_forward(eligible_at(small, new.cutoff_ts), previous, days, new)
