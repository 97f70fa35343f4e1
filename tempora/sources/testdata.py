"""RAW CDC logs derived from the TPC-H-like test tables.

The test tables have no CDC logs of their own, so each log is derived from
them by plain column formulas (the same formulas the DuckDB oracle uses, see
``tempora.plans.oracle``). The planted cases: late payment, late cancel that
lands exactly on a midnight cutoff, late refund, tombstone, stale event that
arrives late and must lose, missing extra info, late subsidiary correction,
delete that still counts, ties on event time, NULL quantity / value / purchase
reference on items.

Each order yields up to six purchase events. They are produced in ONE scan of
``orders``: every candidate version is a ``when(cond, struct)`` in an array,
the array is exploded and NULL versions dropped (codegen'd Generate), so
the scan is not repeated once per version as a UNION ALL would do.

Notation: k = o_orderkey, D = o_orderdate (midnight), e0 = D + (k % 24) hours,
ym = year(D) * 100 + month(D), od = date of D.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora import schemas as S


# Fixed schemas of the test tables, restricted to the columns the logs use.
# Declaring them skips parquet schema inference (a footer-reading job per read)
# and keeps the column types stable.
TEST_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_returnflag STRING, l_shipdate TIMESTAMP_NTZ",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a test table with its declared schema (no inference)."""
    reader = spark.read.schema(TEST_SCHEMAS[name]) if name in TEST_SCHEMAS else spark.read
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _explode_versions(df: DataFrame, versions: list[tuple[str, dict[str, str]]], keep: list[str]) -> DataFrame:
    """One output row per (input row, version whose condition holds).

    Versions are SQL expressions: each becomes ``CASE WHEN cond THEN
    named_struct(...) END`` in one array; explode + ``IS NOT NULL`` keeps the
    live ones. It stays in whole-stage codegen (a filter() lambda would not),
    and the whole projection is one parsed expression, not hundreds of
    Column calls from the driver.
    """
    names = list(versions[0][1].keys())
    structs = []
    for cond, cols in versions:
        fields = ", ".join(f"'{n}', {cols[n]}" for n in names)
        structs.append(f"CASE WHEN {cond} THEN named_struct({fields}) END")
    arr = "explode(array(" + ", ".join(structs) + ")) AS _v"
    return (df.selectExpr(*keep, arr).where("_v IS NOT NULL")
              .selectExpr(*keep, *[f"_v.{n} AS {n}" for n in names]))


# Order terms: k, D (midnight), e0 = D + (k % 24) hours, ym = yyyymm, od = order day.
_ORDER_TERMS = [
    "o_orderkey AS k",
    "o_orderdate AS D",
    "o_orderdate + make_dt_interval(0, CAST(o_orderkey % 24 AS INT)) AS e0",
    "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS ym",
    "CAST(o_orderdate AS DATE) AS od",
    "o_custkey", "o_orderstatus", "o_totalprice",
]


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_ORDER_TERMS)


def _purchase_version(op: str, status: str, release: str, event_ts: str, ingestion_ts: str) -> dict[str, str]:
    return {"op": f"'{op}'", "purchase_status": status, "release_date": release,
            "event_ts": event_ts, "ingestion_ts": ingestion_ts}


_PURCHASE_VERSIONS = [
    ("TRUE", _purchase_version(
        "c", "CASE WHEN k % 29 = 5 THEN CAST(NULL AS STRING) WHEN o_orderstatus = 'O' THEN 'INICIADA' "
             "ELSE 'APROVADA' END",
        "CASE WHEN o_orderstatus = 'O' THEN CAST(NULL AS DATE) ELSE od END", "e0", "e0 + INTERVAL '1' DAY")),
    ("o_orderstatus = 'O' AND k % 3 = 0", _purchase_version(
        "u", "'APROVADA'", "od", "e0 + INTERVAL '5' MINUTE", "D + INTERVAL '15' DAY")),
    ("k % 10 = 2", _purchase_version(
        "u", "'CANCELADA'", "od", "e0 + INTERVAL '3' HOUR", "D + INTERVAL '20' DAY")),
    ("k % 17 = 0", _purchase_version(
        "u", "'REEMBOLSADA'", "od", "e0 + INTERVAL '4' HOUR", "D + INTERVAL '40' DAY")),
    ("k % 50 = 7", _purchase_version(
        "d", "'APROVADA'", "od", "e0 + INTERVAL '6' HOUR", "e0 + INTERVAL '30' DAY")),
    ("k % 13 = 0", _purchase_version(
        "u", "'APROVADA'", "od", "e0 - INTERVAL '1' HOUR", "e0 + INTERVAL '25' DAY")),
]


def purchase_cdc(spark: SparkSession, sf_dir: str, derived: bool = False) -> DataFrame:
    x = _explode_versions(_orders(spark, sf_dir), _PURCHASE_VERSIONS, ["k", "ym", "od", "o_custkey", "o_totalprice"])
    out = x.selectExpr(
        "k AS purchase_id", "ym AS purchase_partition", "o_custkey AS buyer_id",
        "CAST(NULL AS BIGINT) AS prod_item_id", "CAST(NULL AS BIGINT) AS prod_item_partition",
        "CAST(NULL AS BIGINT) AS producer_id", "od AS order_date", "release_date",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS purchase_total_value",
        "purchase_status", "op", "event_ts", "ingestion_ts",
    )
    return with_ingest_day(out) if derived else out


_EXTRA_VERSIONS = [
    ("k % 37 <> 3", {"op": "'c'", "subsidiary": "r_name", "event_ts": "e0",
                     "ingestion_ts": "e0 + INTERVAL '1' DAY + INTERVAL '1' MINUTE"}),
    ("k % 8 = 1", {"op": "'u'", "subsidiary": "n_name", "event_ts": "e0 + INTERVAL '30' MINUTE",
                   "ingestion_ts": "e0 + INTERVAL '18' DAY"}),
    ("k % 41 = 6", {"op": "'d'", "subsidiary": "r_name", "event_ts": "e0 + INTERVAL '45' MINUTE",
                    "ingestion_ts": "e0 + INTERVAL '19' DAY"}),
]


def extra_cdc(spark: SparkSession, sf_dir: str, derived: bool = False) -> DataFrame:
    # the terms are computed after the join: its shuffle carries what they are made of
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    cust = table(spark, sf_dir, "customer")
    geo = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"),
                                              F.col("n_regionkey") == F.col("r_regionkey"))
    # orders x customer grow with the data (sort-merge join); the fixed-size
    # nation x region side is left to the planner's size-checked broadcast.
    j = (o.join(cust.hint("merge"), F.col("o_custkey") == F.col("c_custkey"))
         .join(geo, F.col("c_nationkey") == F.col("n_nationkey")))
    terms = [t for t in _ORDER_TERMS if t.split(" AS ")[-1] in ("k", "e0", "ym")]
    x = _explode_versions(j.selectExpr(*terms, "r_name", "n_name"), _EXTRA_VERSIONS, ["k", "ym"])
    out = x.selectExpr("k AS purchase_id", "ym AS purchase_partition", "subsidiary", "op", "event_ts",
                       "ingestion_ts")
    return with_ingest_day(out) if derived else out


def item_cdc(spark: SparkSession, sf_dir: str, derived: bool = False, distinct: bool = True) -> DataFrame:
    """Item log. Repeated (order, line) pairs in lineitem give several versions.

    ``distinct=False`` keeps exact duplicate events; they cannot change any
    pick of the latest version (a replayed event is the same row), so the
    snapshot path skips that shuffle.
    """
    o = _orders(spark, sf_dir).select("k", "ym")
    # What the join's shuffle carries is narrow: one flag for two columns, the price as the decimal it
    # becomes (a price that does not fit goes as it is, so that it fails only where its order is there).
    li = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate",
        "coalesce(l_returnflag = 'R' AND l_suppkey % 20 = 0, FALSE) AS gone",
        "try_cast(l_extendedprice AS DECIMAL(18,2)) AS price",
        "CASE WHEN try_cast(l_extendedprice AS DECIMAL(18,2)) IS NULL THEN l_extendedprice END AS odd_price")
    # Both sides grow with the data: a shuffle (sort-merge) join, never a
    # broadcast of orders; it also spreads the derivation over all reducers.
    j = li.join(o.hint("merge"), F.col("l_orderkey") == F.col("k"))
    ev = "(l_shipdate + make_dt_interval(0, l_linenumber))"
    out = j.selectExpr(
        "l_orderkey * 10 + l_linenumber AS prod_item_id",
        "ym AS prod_item_partition",
        "CASE WHEN l_partkey % 101 = 0 THEN CAST(NULL AS BIGINT) ELSE l_orderkey END AS purchase_id",
        "ym AS purchase_partition",
        "l_partkey AS product_id",
        "CASE WHEN l_partkey % 97 = 0 THEN CAST(NULL AS INT) ELSE CAST(l_quantity AS INT) END AS item_quantity",
        "CASE WHEN l_partkey % 89 = 0 THEN CAST(NULL AS DECIMAL(18,2)) "
        "ELSE coalesce(price, CAST(odd_price AS DECIMAL(18,2))) END AS purchase_value",
        "CASE WHEN gone THEN 'd' ELSE 'c' END AS op",
        f"{ev} AS event_ts",
        f"{ev} + INTERVAL '1' DAY + make_dt_interval(0, 0, CAST(l_partkey AS INT)) AS ingestion_ts",
    )
    if distinct:
        out = out.distinct()
    return with_ingest_day(out) if derived else out


_COST_VERSIONS = [
    ("k % 9 <> 4", {"op": "'c'", "order_transaction_cost_vat_value": "CAST(k % 500 AS DECIMAL(18,2))",
                    "order_transaction_cost_installment_value":
                        "CASE WHEN k % 7 = 0 THEN CAST(NULL AS DECIMAL(18,2)) "
                        "ELSE CAST(o_custkey % 50 AS DECIMAL(18,2)) END",
                    "event_ts": "e0", "ingestion_ts": "e0 + INTERVAL '1' DAY"}),
    ("k % 6 = 0", {"op": "'u'", "order_transaction_cost_vat_value": "CAST(k % 300 AS DECIMAL(18,2))",
                   "order_transaction_cost_installment_value": "CAST(o_custkey % 50 AS DECIMAL(18,2))",
                   "event_ts": "e0", "ingestion_ts": "e0 + INTERVAL '16' DAY"}),
    ("k % 31 = 2", {"op": "'d'", "order_transaction_cost_vat_value": "CAST(0 AS DECIMAL(18,2))",
                    "order_transaction_cost_installment_value": "CAST(1 AS DECIMAL(18,2))",
                    "event_ts": "e0 + INTERVAL '1' HOUR", "ingestion_ts": "e0 + INTERVAL '17' DAY"}),
]


def cost_cdc(spark: SparkSession, sf_dir: str, derived: bool = False) -> DataFrame:
    x = _explode_versions(_orders(spark, sf_dir), _COST_VERSIONS, ["k", "ym", "od"])
    out = x.selectExpr(
        "k AS purchase_id", "ym AS purchase_partition",
        "order_transaction_cost_vat_value", "order_transaction_cost_installment_value",
        "od AS order_transaction_cost_date", "op", "event_ts", "ingestion_ts",
    )
    return with_ingest_day(out) if derived else out


def with_ingest_day(df: DataFrame) -> DataFrame:
    """RAW derived column: ``transaction_date`` = ingest day."""
    return df.withColumn("transaction_date", F.to_date("ingestion_ts"))


DERIVERS = {S.PURCHASE: purchase_cdc, S.EXTRA: extra_cdc, S.ITEM: item_cdc, S.COST: cost_cdc}


def cdc_logs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All four logs, as the snapshot path reads them."""
    return {
        S.PURCHASE: purchase_cdc(spark, sf_dir),
        S.EXTRA: extra_cdc(spark, sf_dir),
        S.ITEM: item_cdc(spark, sf_dir, distinct=False),
        S.COST: cost_cdc(spark, sf_dir),
    }


def dirty_purchase_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase log with planted bad rows for the quality gates:
    op 'x' when k % 71 = 0, NULL purchase_id when k % 73 = 0."""
    p = purchase_cdc(spark, sf_dir)
    return (p.withColumn("op", F.when(F.col("purchase_id") % 71 == 0, F.lit("x")).otherwise(F.col("op")))
             .withColumn("purchase_id", F.when(F.col("purchase_id") % 73 == 0, F.lit(None).cast("long"))
                         .otherwise(F.col("purchase_id"))))


def replayed_purchase_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase log delivered twice for orders with k % 5 = 0 (a replay)."""
    p = purchase_cdc(spark, sf_dir)
    return p.unionByName(p.where(F.col("purchase_id") % 5 == 0))
