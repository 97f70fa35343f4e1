"""Fixed schemas of the RAW CDC logs and the GOLD table (no inference anywhere).

Money is DECIMAL(18,2); timestamps carry no zone (TIMESTAMP_NTZ).
Every RAW log ends with ``op`` (c/u/d), ``event_ts``, ``ingestion_ts`` and the
derived ``transaction_date`` = date of ``ingestion_ts`` (the ingest day, the
RAW partition column).
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
TS = T.TimestampNTZType()

# Names of the four RAW logs and of the GOLD table.
PURCHASE = "purchase_cdc"
ITEM = "product_item_cdc"
EXTRA = "purchase_extra_info_cdc"
COST = "order_transaction_cost_hist_cdc"
GOLD = "gmv_daily_subsidiary_hist"

CDC_TAIL = [
    T.StructField("op", T.StringType(), False),
    T.StructField("event_ts", TS, False),
    T.StructField("ingestion_ts", TS, False),
]


def _with_tail(fields, derived: bool) -> T.StructType:
    tail = list(CDC_TAIL)
    if derived:
        tail.append(T.StructField("transaction_date", T.DateType(), True))
    return T.StructType(list(fields) + tail)


_PURCHASE_FIELDS = [
    T.StructField("purchase_id", T.LongType(), False),
    T.StructField("purchase_partition", T.LongType(), False),
    T.StructField("buyer_id", T.LongType(), True),
    T.StructField("prod_item_id", T.LongType(), True),
    T.StructField("prod_item_partition", T.LongType(), True),
    T.StructField("producer_id", T.LongType(), True),
    T.StructField("order_date", T.DateType(), True),
    T.StructField("release_date", T.DateType(), True),
    T.StructField("purchase_total_value", MONEY, True),
    T.StructField("purchase_status", T.StringType(), True),
]

_ITEM_FIELDS = [
    T.StructField("prod_item_id", T.LongType(), False),
    T.StructField("prod_item_partition", T.LongType(), False),
    T.StructField("purchase_id", T.LongType(), True),
    T.StructField("purchase_partition", T.LongType(), True),
    T.StructField("product_id", T.LongType(), True),
    T.StructField("item_quantity", T.IntegerType(), True),
    T.StructField("purchase_value", MONEY, True),
]

_EXTRA_FIELDS = [
    T.StructField("purchase_id", T.LongType(), False),
    T.StructField("purchase_partition", T.LongType(), False),
    T.StructField("subsidiary", T.StringType(), True),
]

_COST_FIELDS = [
    T.StructField("purchase_id", T.LongType(), False),
    T.StructField("purchase_partition", T.LongType(), False),
    T.StructField("order_transaction_cost_vat_value", MONEY, True),
    T.StructField("order_transaction_cost_installment_value", MONEY, True),
    T.StructField("order_transaction_cost_date", T.DateType(), True),
]

_FIELDS = {PURCHASE: _PURCHASE_FIELDS, ITEM: _ITEM_FIELDS, EXTRA: _EXTRA_FIELDS, COST: _COST_FIELDS}

# Entity key of each log: the pick of the latest version runs per key.
ENTITY_KEYS = {
    PURCHASE: ["purchase_id", "purchase_partition"],
    ITEM: ["prod_item_id", "prod_item_partition"],
    EXTRA: ["purchase_id", "purchase_partition"],
    COST: ["purchase_id", "purchase_partition"],
}
# Unique key of each RAW log: one row per entity version.
RAW_KEYS = {t: k + ["event_ts", "ingestion_ts"] for t, k in ENTITY_KEYS.items()}
PURCHASE_KEY = ["purchase_id", "purchase_partition"]

# Status codes that never count as GMV.
EXCLUDED_STATUSES = ["CANCELADA", "REEMBOLSADA"]
# The CDC operation domain (create, update, delete).
OPS = ["c", "u", "d"]


def raw_schema(table: str, derived: bool = False) -> T.StructType:
    """Schema of a RAW log; ``derived`` adds the ingest-day column."""
    return _with_tail(_FIELDS[table], derived)


def required_columns(table: str) -> list[str]:
    """Columns declared NOT NULL for a RAW log."""
    return [f.name for f in raw_schema(table) if not f.nullable]


GOLD_SCHEMA = T.StructType([
    T.StructField("transaction_date", T.DateType(), False),
    T.StructField("subsidiary", T.StringType(), False),
    T.StructField("as_of_date", T.DateType(), False),
    T.StructField("gmv_amount", MONEY, False),
    T.StructField("purchases_count", T.IntegerType(), False),
    T.StructField("source_max_ingestion_ts", TS, False),
    T.StructField("run_id", T.StringType(), False),
])
GOLD_KEY = ["transaction_date", "subsidiary", "as_of_date"]
GOLD_COLUMNS = [f.name for f in GOLD_SCHEMA]
