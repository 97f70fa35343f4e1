"""SILVER to GOLD: items per purchase, eligible purchases, daily GMV snapshot.

Shuffle budget for one snapshot: one hash exchange per log for the pick
(purchase, extra info and item keys), one for the item sum per purchase and
one for the (day, subsidiary) aggregate. The two joins on the purchase key
reuse the hash partitioning of the picks and of the item sum, so they add
no exchange. Every aggregate runs partial (map side) then final.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora import schemas as S
from tempora.functions.metrics import METRICS
from tempora.functions.rules import RunParams, date_lit, item_amount, not_deleted, purchase_eligible
from tempora.operators.latest import latest_as_of, latest_intervals

PK = S.PURCHASE_KEY

PURCHASE_COLS = ["order_date", "release_date", "purchase_status"]
EXTRA_COLS = ["subsidiary"]
ITEM_COLS = ["purchase_id", "purchase_partition", "item_quantity", "purchase_value"]
COST_COLS = ["order_transaction_cost_vat_value", "order_transaction_cost_installment_value"]


def items_by_purchase(items_latest: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Live items (winner not deleted) summed per purchase.

    Items whose purchase reference is NULL form a NULL group that can never
    join; the inner join downstream lets Catalyst drop them before the sum.
    """
    return (items_latest.where(not_deleted())
            .groupBy(*by, *PK)
            .agg(F.sum(item_amount()).alias("amount_total"),
                 F.max("ingestion_ts").alias("max_item_ingestion")))


def eligible_purchases(purchase_latest: DataFrame, extra_latest: DataFrame, items_sum: DataFrame,
                       honor_deletes: bool = False) -> DataFrame:
    """Purchases that count as GMV at the cutoff, with their day and subsidiary.

    Inner joins: a purchase without extra info or without a live item is out.
    Extra info is taken whatever its ``op`` (a deleted subsidiary still counts);
    ``honor_deletes=True`` drops purchases whose extra-info winner is a delete.
    """
    p = purchase_latest.where(purchase_eligible()).select(
        *PK, F.col("order_date").alias("transaction_date"), F.col("ingestion_ts").alias("_p_ing"))
    if honor_deletes:
        extra_latest = extra_latest.where(not_deleted())
    e = extra_latest.select(*PK, "subsidiary", F.col("ingestion_ts").alias("_e_ing"))
    j = p.join(e, PK).join(items_sum, PK)
    return j.select(
        *PK, "transaction_date", "subsidiary",
        F.col("amount_total").alias("gmv_amount"),
        F.greatest("_p_ing", "_e_ing", "max_item_ingestion").alias("max_ingestion_ts"),
    )


def silver(logs: Mapping[str, DataFrame], cutoff) -> dict[str, DataFrame]:
    """The three latest-state views a snapshot needs, at one cutoff."""
    return {
        "purchase": latest_as_of(logs[S.PURCHASE], PK, cutoff, PURCHASE_COLS),
        "extra": latest_as_of(logs[S.EXTRA], PK, cutoff, EXTRA_COLS),
        "item": latest_as_of(logs[S.ITEM], S.ENTITY_KEYS[S.ITEM], cutoff, ITEM_COLS),
    }


def snapshot_from_states(purchase: DataFrame, extra: DataFrame, item: DataFrame, run: RunParams, honor_deletes: bool = False) -> DataFrame:
    """The GOLD snapshot of ``run`` from the latest states at its day, however they were found."""
    return _gold(aggregate_snapshot(eligible_purchases(purchase, extra, items_by_purchase(item), honor_deletes)), run)


def _gold(totals: DataFrame, run: RunParams) -> DataFrame:
    return totals.select(
        "transaction_date", "subsidiary", date_lit(run.as_of_date).alias("as_of_date"),
        "gmv_amount", "purchases_count", "source_max_ingestion_ts", F.lit(run.run_id).alias("run_id"))


def eligible_at(logs: Mapping[str, DataFrame], cutoff, honor_deletes: bool = False) -> DataFrame:
    s = silver(logs, cutoff)
    return eligible_purchases(s["purchase"], s["extra"], items_by_purchase(s["item"]), honor_deletes=honor_deletes)


def aggregate_snapshot(eligible: DataFrame) -> DataFrame:
    """(day, subsidiary) totals with the audit column."""
    return (eligible.groupBy("transaction_date", "subsidiary")
            .agg(METRICS["gmv"]().alias("gmv_amount"),
                 METRICS["purchases_count"]().alias("purchases_count"),
                 F.max("max_ingestion_ts").alias("source_max_ingestion_ts")))


def gmv_snapshot(logs: Mapping[str, DataFrame], run: RunParams, honor_deletes: bool = False) -> DataFrame:
    """One full GOLD snapshot for ``run``, in the GOLD column order."""
    return _gold(aggregate_snapshot(eligible_at(logs, run.cutoff_ts, honor_deletes)), run)


def _levels(runs: int) -> range:
    """Powers of two up to the first that holds all runs."""
    return range(max(runs - 1, 1).bit_length() + 1)


def _span(start: Column, level: int, runs: int) -> Column:
    """Number of the aligned span of 2**level runs at ``start``: the widest is 1, the halves of span n are 2n and 2n + 1."""
    return F.lit(1 << (_levels(runs)[-1] - level)) + F.shiftright(start, level)


def _spans_over(run: Column, runs: int) -> Column:
    """The aligned spans that hold a run: one per power of two."""
    return F.array(*[_span(run, level, runs) for level in _levels(runs)])


def _spans(first: Column, last: Column, runs: int) -> Column:
    """The runs ``first`` to ``last`` as few aligned spans, numbered: at most two per power of two.

    A level takes the span to the left of what the next level can take, where
    that begins later, and the one to its right, where it ends earlier.
    """
    end, parts = last + 1, []
    for level in _levels(runs):
        up, down = (F.shiftleft(F.shiftright(x, level), level) for x in (first + ((1 << level) - 1), end))
        up2, down2 = (F.shiftleft(F.shiftright(x, level + 1), level + 1) for x in (first + ((2 << level) - 1), end))
        fits, wider = up < down, up2 < down2
        left = fits & F.when(wider, up < up2).otherwise(F.lit(True))
        right = fits & F.when(wider, down2 < down).otherwise(down - up > (1 << level))
        parts += [F.when(left, _span(up, level, runs)), F.when(right, _span(down - (1 << level), level, runs))]
    return F.array_compact(F.array(*parts))


def eligible_intervals(logs: Mapping[str, DataFrame], runs: Sequence[RunParams]) -> DataFrame:
    """Eligible purchases by interval of runs: day, subsidiary, gmv_amount, max_ingestion_ts, first_run, last_run.

    A purchase is constant between the runs at which one of its versions, its
    extra info or one of its items changes; each such segment is evaluated
    once, by a sweep: an item adds its amount at the first run it wins and
    takes it off after the last, summed per (purchase, run) before the shuffle;
    running sums, and the last purchase and extra version carried forward, give
    the segments. The newest arrival is a running maximum over the items that
    stay. Those that go (replaced, moved or deleted) cover aligned spans of
    runs, at most two per power of two, and a segment looks up the spans over
    its run; a purchase has fewer than four spans per run, however many items.
    So the rows follow the number of changes, also for a purchase with very
    many items or changes.
    """
    p = latest_intervals(logs[S.PURCHASE], PK, runs, PURCHASE_COLS)
    e = latest_intervals(logs[S.EXTRA], PK, runs, EXTRA_COLS)
    i = latest_intervals(logs[S.ITEM], S.ENTITY_KEYS[S.ITEM], runs, ITEM_COLS)
    return segments(p, e, i, len(runs))


def segments(p: DataFrame, e: DataFrame, i: DataFrame, runs: int) -> DataFrame:
    """``eligible_intervals`` from the three logs' winners with the runs they win."""
    first, last = F.col("first_run"), F.col("last_run")
    live = i.where(not_deleted()).where(F.col("purchase_id").isNotNull() & F.col("purchase_partition").isNotNull())
    live = live.select(*PK, item_amount().alias("amount"), "ingestion_ts", "first_run", "last_run")
    stays, none = last == runs - 1, F.lit(None)
    step = lambda run, span, sign, seen: F.struct(
        run.alias("run"), span.alias("span"), (sign * F.col("amount")).alias("amount"), sign.alias("n"), seen.alias("seen"))
    comes = step(first, none.cast("int"), F.lit(1), F.when(stays, F.col("ingestion_ts")))
    goes = step(last + 1, none.cast("int"), F.lit(-1), none.cast("timestamp_ntz"))
    covers = F.transform(_spans(first, last, runs), lambda span: step(none.cast("int"), span, F.lit(0), F.col("ingestion_ts")))
    steps = live.select(*PK, F.explode(F.when(stays, F.array(comes)).otherwise(F.concat(F.array(comes, goes), covers))).alias("s")).select(*PK, "s.*")
    items = steps.groupBy(*PK, "run", "span").agg(F.sum("amount").alias("amount"), F.sum("n").alias("n"), F.max("seen").alias("seen"))
    facts = items.unionByName(p.select(*PK, first.alias("run"), purchase_eligible().alias("counts"), "order_date", F.col("ingestion_ts").alias("p_at")),
                              allowMissingColumns=True)
    facts = facts.unionByName(e.select(*PK, first.alias("run"), "subsidiary", F.col("ingestion_ts").alias("e_at")), allowMissingColumns=True)
    whole = Window.partitionBy(*PK)
    by = whole.orderBy("run")  # spans, which have no run, come first
    upto = by.rangeBetween(Window.unboundedPreceding, Window.currentRow)  # all changes of the same run
    held = {c: F.last(c, True).over(upto) for c in ("counts", "p_at", "e_at")}
    # these two may be NULL in a version, so they are carried with the arrival that brought them
    held |= {c: F.last(F.when(F.col(at).isNotNull(), F.struct(c)), True).over(upto)[c] for c, at in (("order_date", "p_at"), ("subsidiary", "e_at"))}
    held |= {"amount": F.sum("amount").over(upto), "n": F.sum("n").over(upto), "seen": F.max(F.when(F.col("span").isNull(), F.col("seen"))).over(upto)}
    held |= {"_next": F.lead("run").over(by), "gone": F.collect_list(F.when(F.col("span").isNotNull(), F.struct("span", "seen"))).over(whole)}
    segs = facts.select(*PK, "run", *[c.alias(k) for k, c in held.items()]).where("run IS NOT NULL AND (_next IS NULL OR _next > run)")
    over = F.filter("gone", lambda g: F.array_contains(_spans_over(F.col("run"), runs), g["span"]))
    return segs.where("counts AND e_at IS NOT NULL AND n > 0").select(
        F.col("order_date").alias("transaction_date"), "subsidiary", F.col("run").alias("first_run"),
        F.coalesce(F.col("_next") - 1, F.lit(runs - 1)).alias("last_run"), F.col("amount").alias("gmv_amount"),
        F.greatest("p_at", "e_at", "seen", F.array_max(F.transform(over, lambda g: g["seen"]))).alias("max_ingestion_ts"))


def multi_snapshot(logs: Mapping[str, DataFrame], runs: Sequence[RunParams]) -> DataFrame:
    """Several snapshots in one job; equals the union of single runs.

    Only changes cross the network: totals are summed per (day, subsidiary,
    interval of runs) and spread over the runs at that grain.
    """
    runs = sorted(runs, key=lambda r: r.cutoff_ts)
    by = ["transaction_date", "subsidiary"]
    parts = eligible_intervals(logs, runs).groupBy(*by, "first_run", "last_run").agg(
        F.sum("gmv_amount").alias("gmv_amount"), F.count(F.lit(1)).alias("n"), F.max("max_ingestion_ts").alias("seen"))
    spread = parts.withColumn("run", F.explode(F.sequence("first_run", "last_run")))
    as_of, run_ids = (F.element_at(F.array(*x), F.col("run") + 1) for x in (
        [date_lit(r.as_of_date) for r in runs], [F.lit(r.run_id) for r in runs]))
    agg = spread.groupBy(*by, "run").agg(METRICS["gmv"]().alias("gmv_amount"), F.sum("n").cast("int").alias("purchases_count"),
                                         F.max("seen").alias("source_max_ingestion_ts"))
    return agg.select(*by, as_of.alias("as_of_date"), "gmv_amount", "purchases_count", "source_max_ingestion_ts", run_ids.alias("run_id"))
