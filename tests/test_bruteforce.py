"""A second, independent oracle: the snapshot and the margin computed by plain
Python loops over the sf0.001 logs, compared with the Spark operators at
several cutoffs (including one landing exactly on late-cancel arrivals)."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from decimal import Decimal

import pytest

from tempora import schemas as S
from tempora.functions.rules import RunParams
from tempora.operators.gmv import gmv_snapshot
from tempora.operators.margin import contribution_margin

EXCLUDED = {"CANCELADA", "REEMBOLSADA"}


@pytest.fixture(scope="module")
def rows(small_logs):
    return {t: [r.asDict() for r in df.collect()] for t, df in small_logs.items()}


def _latest(events, key, cutoff):
    best = {}
    for e in events:
        if e["ingestion_ts"] >= cutoff:
            continue
        k = tuple(e[c] for c in key)
        if k not in best or (e["event_ts"], e["ingestion_ts"]) > (best[k]["event_ts"], best[k]["ingestion_ts"]):
            best[k] = e
    return best


def _eligible(rows, cutoff):
    pk = S.PURCHASE_KEY
    purchases = _latest(rows[S.PURCHASE], pk, cutoff)
    extra = _latest(rows[S.EXTRA], pk, cutoff)
    items = _latest(rows[S.ITEM], S.ENTITY_KEYS[S.ITEM], cutoff)
    amount, last_item = defaultdict(Decimal), {}
    for it in items.values():
        if it["op"] == "d" or it["purchase_id"] is None:
            continue
        k = (it["purchase_id"], it["purchase_partition"])
        amount[k] += (it["purchase_value"] or Decimal(0)) * (it["item_quantity"] if it["item_quantity"] is not None else 1)
        last_item[k] = max(last_item.get(k, it["ingestion_ts"]), it["ingestion_ts"])
    out = {}
    for k, p in purchases.items():
        ok = p["release_date"] is not None and p["purchase_status"] not in EXCLUDED and p["op"] != "d"
        if ok and k in extra and k in last_item:
            out[k] = (p["order_date"], extra[k]["subsidiary"], amount[k],
                      max(p["ingestion_ts"], extra[k]["ingestion_ts"], last_item[k]))
    return out


def _snapshot(rows, run):
    agg = {}
    for day, sub, gmv, ts in _eligible(rows, run.cutoff_ts).values():
        g, n, m = agg.get((day, sub), (Decimal(0), 0, ts))
        agg[(day, sub)] = (g + gmv, n + 1, max(m, ts))
    return sorted((d, s, run.as_of_date, g.quantize(Decimal("0.01")), n, m, run.run_id)
                  for (d, s), (g, n, m) in agg.items())


RUNS = [RunParams.for_day(d) for d in ("1996-03-31", "1998-06-30", "1999-01-20", "2001-12-31")]


@pytest.mark.parametrize("run", RUNS, ids=[str(r.as_of_date) for r in RUNS])
def test_snapshot_equals_brute_force(small_logs, rows, run):
    got = sorted(tuple(r) for r in gmv_snapshot(small_logs, run).collect())
    assert got == _snapshot(rows, run)


def test_margin_equals_brute_force(small_logs, rows):
    cutoff = dt.datetime(1998, 7, 1)
    costs = _latest(rows[S.COST], S.PURCHASE_KEY, cutoff)
    agg = {}
    for k, (day, sub, gmv, _) in _eligible(rows, cutoff).items():
        c = costs.get(k)
        cost = Decimal(0) if c is None else ((c["order_transaction_cost_vat_value"] or Decimal(0))
                                             + (c["order_transaction_cost_installment_value"] or Decimal(0)))
        g, cc = agg.get((day, sub), (Decimal(0), Decimal(0)))
        agg[(day, sub)] = (g + gmv, cc + cost)
    want = sorted((d, s, g, c, g - c) for (d, s), (g, c) in agg.items())
    got = sorted(tuple(r) for r in contribution_margin(small_logs, cutoff).collect())
    assert got == want
