"""Quality gates on RAW events and replay handling.

Parquet enforces no NOT NULL, CHECK or key, so the gates run before a write:
one pass tags each row with the first rule it breaks; accepted and rejected
rows are two filters of that tagged frame; the rejected side keeps the row and
the reason. The sink refuses a delivery with rejected rows unless a quarantine
takes them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tempora import schemas as S


def reject_reason(required: Sequence[str] = (), check_op: bool = True, op_col: str = "op") -> Column:
    """First broken rule as a string, NULL when the row passes."""
    rules: list[tuple[Column, str]] = [(F.col(c).isNull(), f"null:{c}") for c in required]
    if check_op:
        rules.append((F.col(op_col).isNotNull() & ~F.col(op_col).isin(*S.OPS), "op"))
    if not rules:
        return F.lit(None).cast("string")
    expr = F.when(rules[0][0], F.lit(rules[0][1]))
    for cond, name in rules[1:]:
        expr = expr.when(cond, F.lit(name))
    return expr


def tag(df: DataFrame, table: str, check_nulls: bool = True, check_op: bool = True) -> DataFrame:
    required = S.required_columns(table) if check_nulls else []
    return df.withColumn("reject_reason", reject_reason(required, check_op))


def observed(tagged: DataFrame, table: str) -> tuple[DataFrame, Observation]:
    """The tagged rows, and what the pass that next computes them counts on the way (no job of its own).

    rejected, rejected_hash (the sum of the rows' hashes, None without one);
    of the sound rows months (ingest months, comma-joined), reached (newest
    arrival), since and until (oldest and newest arrival as text), sound (their
    number) and keys (about how many raw keys they have). Nothing may shuffle the rows before that pass ends: only the tasks of
    a job's last stage are counted once where an executor is lost.
    """
    counts = Observation()
    sound = F.col("reject_reason").isNull()
    month = F.when(sound, F.trunc("transaction_date", "month").cast("string"))
    return tagged.observe(
        counts, F.count_if(~sound).alias("rejected"),
        F.sum(F.when(~sound, F.xxhash64(*tagged.columns)).cast("decimal(38,0)")).alias("rejected_hash"),
        F.concat_ws(",", F.sort_array(F.collect_set(month))).alias("months"),
        F.max(F.when(sound, F.col("ingestion_ts"))).alias("reached"),
        F.min(F.when(sound, F.col("ingestion_ts"))).cast("string").alias("since"),
        F.max(F.when(sound, F.col("ingestion_ts"))).cast("string").alias("until"),
        F.count_if(sound).alias("sound"),
        F.approx_count_distinct(F.when(sound, F.xxhash64(*S.RAW_KEYS[table]))).alias("keys")), counts


def split(df: DataFrame, table: str, check_nulls: bool = True, check_op: bool = True) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); accepted + rejected = input, row for row."""
    t = tag(df, table, check_nulls, check_op)
    accepted = t.where(F.col("reject_reason").isNull()).drop("reject_reason")
    rejected = t.where(F.col("reject_reason").isNotNull())
    return accepted, rejected


def duplicate_keys(df: DataFrame, table: str) -> DataFrame:
    """Raw keys delivered more than once (report; partial count per map task)."""
    key = S.RAW_KEYS[table]
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def _content(columns: Sequence[str]) -> Column:
    """Hash of a whole event, whatever the order of its columns."""
    return F.xxhash64(*sorted(columns))


def judged(batch: DataFrame, stored: DataFrame | None, table: str, copies: bool = False, own_day: bool = True) -> DataFrame:
    """One row per raw key of ``batch`` that is not stored yet or comes with different contents (``clash``).

    A key's contents are compared inside the batch and against ``stored``, of
    which only keys and hashes travel. Rows cross the network once, dealt by
    ranges of (ingest month, key): those of a key lie together, and a month is
    in few tasks, so that a write by month follows without another exchange.
    With ``copies`` (many rows are copies) they are collapsed per map task
    before. Without ``own_day`` every ``transaction_date`` is the day of
    ``ingestion_ts``, and is derived again rather than sent.
    """
    key, cols = S.RAW_KEYS[table], batch.columns
    rows = batch.dropDuplicates() if copies else batch
    rows = rows if own_day else rows.drop("transaction_date")
    if stored is not None:
        rows = rows.unionByName(stored.select(*key, _content(cols).alias("_hash")), allowMissingColumns=True)
    month = F.trunc(F.to_date("ingestion_ts"), "month")  # a function of the key
    dealt = rows.withColumn("_month", month).repartitionByRange("_month", *key)
    dealt = dealt if own_day else dealt.withColumn("transaction_date", F.to_date("ingestion_ts"))
    dealt = dealt if stored is not None else dealt.withColumn("_hash", F.lit(None).cast("long"))
    dealt = dealt.withColumn("_stored", F.col("_hash").isNotNull()).withColumn("_hash", F.coalesce("_hash", _content(cols)))
    of_key = Window.partitionBy("_month", *key).orderBy("_stored")
    whole = of_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = dealt.select(
        *cols, "_stored", (F.min("_hash").over(whole) != F.max("_hash").over(whole)).alias("clash"),
        F.max("_stored").over(whole).alias("_known"), F.row_number().over(of_key).alias("_n"))
    return found.where("_n = 1 AND NOT _stored AND (clash OR NOT _known)").select(*cols, "clash")


def matching(rows: DataFrame, keys: DataFrame, table: str, how: str) -> DataFrame:
    """Rows whose raw key is (``left_semi``) or is not (``left_anti``) among ``keys``."""
    key = S.RAW_KEYS[table]
    return rows.join(keys.select(*key).distinct(), key, how)


def not_stored_yet(batch: DataFrame, stored: DataFrame, table: str) -> DataFrame:
    """Rows of ``batch`` whose raw key is not among ``stored``, the rows of the batch's months."""
    return matching(batch, stored, table, "left_anti")
