"""The small hand-made CDC scenario and its golden results.

Fixed values: mock events (all in partition 202301) and the expected GOLD
rows they must produce. Purchase 2 is cancelled late, purchase 3 is paid
late, purchase 2's subsidiary is corrected late, purchase 3's VAT is
corrected late with the same event time (a tie broken by arrival).
"""

from __future__ import annotations

from tempora import schemas as S
from tempora.sources.inline import from_rows

PURCHASE_COLS = ["purchase_id", "purchase_partition", "buyer_id", "prod_item_id", "prod_item_partition",
                 "producer_id", "order_date", "release_date", "purchase_total_value", "purchase_status",
                 "op", "event_ts", "ingestion_ts"]
PURCHASE_ROWS = [
    (1, 202301, 10, 1001, 202301, 500, "2023-01-06", "2023-01-06", 100.00, "APROVADA",
     "c", "2023-01-06 10:00:00", "2023-01-07 02:00:00"),
    (2, 202301, 11, 1002, 202301, 501, "2023-01-05", "2023-01-05", 200.00, "APROVADA",
     "c", "2023-01-05 09:00:00", "2023-01-07 02:10:00"),
    (2, 202301, 11, 1002, 202301, 501, "2023-01-05", "2023-01-05", 200.00, "CANCELADA",
     "u", "2023-01-05 12:00:00", "2023-01-10 01:00:00"),
    (3, 202301, 12, 1003, 202301, 502, "2023-01-06", None, 150.00, "INICIADA",
     "c", "2023-01-06 08:00:00", "2023-01-07 02:20:00"),
    (3, 202301, 12, 1003, 202301, 502, "2023-01-06", "2023-01-06", 150.00, "APROVADA",
     "u", "2023-01-06 08:05:00", "2023-01-10 01:10:00"),
]

EXTRA_COLS = ["purchase_id", "purchase_partition", "subsidiary", "op", "event_ts", "ingestion_ts"]
EXTRA_ROWS = [
    (1, 202301, "S1", "c", "2023-01-06 10:00:00", "2023-01-07 02:01:00"),
    (2, 202301, "S1", "c", "2023-01-05 09:00:00", "2023-01-07 02:11:00"),
    (2, 202301, "S2", "u", "2023-01-05 09:30:00", "2023-01-10 01:05:00"),
    (3, 202301, "S2", "c", "2023-01-06 08:00:00", "2023-01-07 02:21:00"),
]

ITEM_COLS = ["prod_item_id", "prod_item_partition", "purchase_id", "purchase_partition", "product_id",
             "item_quantity", "purchase_value", "op", "event_ts", "ingestion_ts"]
ITEM_ROWS = [
    (1001, 202301, 1, 202301, 9001, 1, 100.00, "c", "2023-01-06 10:00:00", "2023-01-07 02:00:30"),
    (1002, 202301, 2, 202301, 9002, 1, 200.00, "c", "2023-01-05 09:00:00", "2023-01-07 02:10:30"),
    (1003, 202301, 3, 202301, 9003, 1, 150.00, "c", "2023-01-06 08:00:00", "2023-01-07 02:20:30"),
]

COST_COLS = ["purchase_id", "purchase_partition", "order_transaction_cost_vat_value",
             "order_transaction_cost_installment_value", "order_transaction_cost_date", "op", "event_ts",
             "ingestion_ts"]
COST_ROWS = [
    (1, 202301, 2.00, 1.00, "2023-01-06", "c", "2023-01-06 10:00:00", "2023-01-07 03:00:00"),
    (2, 202301, 4.00, 2.00, "2023-01-05", "c", "2023-01-05 09:00:00", "2023-01-07 03:00:00"),
    (3, 202301, 3.00, 1.50, "2023-01-06", "c", "2023-01-06 08:00:00", "2023-01-07 03:00:00"),
    (3, 202301, 2.50, 1.50, "2023-01-06", "u", "2023-01-06 08:00:00", "2023-01-10 03:00:00"),
]

# Golden GOLD rows: (as_of_date, transaction_date, subsidiary, gmv, count, source_max_ingestion_ts, run_id)
GOLDEN_SNAPSHOTS = [
    ("2023-01-07", "2023-01-05", "S1", "200.00", 1, "2023-01-07 02:11:00", "2023-01-07_d-1"),
    ("2023-01-07", "2023-01-06", "S1", "100.00", 1, "2023-01-07 02:01:00", "2023-01-07_d-1"),
    ("2023-01-10", "2023-01-06", "S1", "100.00", 1, "2023-01-07 02:01:00", "2023-01-10_d-1"),
    ("2023-01-10", "2023-01-06", "S2", "150.00", 1, "2023-01-10 01:10:00", "2023-01-10_d-1"),
]

# Golden margin rows: (cutoff, transaction_date, subsidiary, gmv, cost, contribution_margin)
GOLDEN_MARGIN = [
    ("2023-01-11 00:00:00", "2023-01-06", "S1", "100.00", "3.00", "97.00"),
    ("2023-01-11 00:00:00", "2023-01-06", "S2", "150.00", "4.00", "146.00"),
    ("2023-01-08 00:00:00", "2023-01-05", "S1", "200.00", "6.00", "194.00"),
    ("2023-01-08 00:00:00", "2023-01-06", "S1", "100.00", "3.00", "97.00"),
]


def mock_logs(spark):
    return {
        S.PURCHASE: from_rows(spark, S.PURCHASE, PURCHASE_COLS, PURCHASE_ROWS),
        S.EXTRA: from_rows(spark, S.EXTRA, EXTRA_COLS, EXTRA_ROWS),
        S.ITEM: from_rows(spark, S.ITEM, ITEM_COLS, ITEM_ROWS),
        S.COST: from_rows(spark, S.COST, COST_COLS, COST_ROWS),
    }
