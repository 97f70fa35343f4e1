"""Run parameters and the business rules as JVM-side Column expressions.

All rules are built-in ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; nothing here is a Python UDF.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tempora import schemas as S


def _as_date(d) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


@dataclass(frozen=True)
class RunParams:
    """One snapshot run: ``as_of_date``, strict ``cutoff_ts`` and ``run_id``.

    The cutoff is the midnight after ``as_of_date``: an event belongs to the
    run when ``ingestion_ts < cutoff_ts``.
    """

    as_of_date: dt.date
    cutoff_ts: dt.datetime
    run_id: str

    @classmethod
    def for_day(cls, as_of_date, run_id: str | None = None) -> "RunParams":
        d = _as_date(as_of_date)
        cutoff = dt.datetime.combine(d + dt.timedelta(days=1), dt.time())
        # Fixed value: run id format "<as_of_date>_d-1" (a D-1 batch run).
        return cls(d, cutoff, run_id or f"{d.isoformat()}_d-1")

    @property
    def cutoff_literal(self) -> str:
        return self.cutoff_ts.strftime("%Y-%m-%d %H:%M:%S")


def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal (string cast: independent of the session zone)."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp_ntz")


def date_lit(value) -> Column:
    return F.lit(_as_date(value).isoformat()).cast("date")


def _ntz_sql(value) -> str:
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return f"TIMESTAMP_NTZ '{value}'"


def known_before(cutoff, col: str = "ingestion_ts") -> Column:
    """What was known at the cutoff: strict ``ingestion_ts < cutoff``."""
    if isinstance(cutoff, Column):
        return F.col(col) < cutoff
    return F.expr(f"{col} < {_ntz_sql(cutoff)}")


def not_deleted(col: str = "op") -> Column:
    return F.col(col) != F.lit("d")


def paid() -> Column:
    """Payment confirmed: ``release_date`` is set."""
    return F.col("release_date").isNotNull()


def status_counts() -> Column:
    """Null-safe status rule: NULL status is eligible."""
    return F.col("purchase_status").isNull() | ~F.col("purchase_status").isin(*S.EXCLUDED_STATUSES)


def purchase_eligible() -> Column:
    """Eligibility of a purchase's winning version (tested after the pick)."""
    return paid() & status_counts() & not_deleted()


def item_amount() -> Column:
    """Unit value times quantity; missing value is 0, missing quantity is 1."""
    return F.coalesce(F.col("purchase_value"), F.lit(0)) * F.coalesce(F.col("item_quantity"), F.lit(1))


def cost_total() -> Column:
    """VAT plus installment; a missing component counts 0."""
    return (F.coalesce(F.col("order_transaction_cost_vat_value"), F.lit(0))
            + F.coalesce(F.col("order_transaction_cost_installment_value"), F.lit(0)))


def money(c: Column) -> Column:
    """Narrow a widened decimal sum back to DECIMAL(18,2); overflow raises under ANSI."""
    return c.cast(S.MONEY)
