"""Column expressions. All of them stay inside generated code; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RETURN_PREFIX = "C"


def standard_text(col: str | Column) -> Column:
    """Upper case without leading and trailing spaces. Tabs and newlines stay."""
    return F.upper(F.trim(col))


def as_money(col: Column) -> Column:
    """Text to an amount with cents, half a cent away from zero; fails beyond 10^8."""
    return col.cast("decimal(12,2)").cast("decimal(10,2)")


def return_flag(invoice_no: str = "invoice_no") -> Column:
    """True for a returned line. A missing number is no return."""
    return F.when(F.col(invoice_no).startswith(RETURN_PREFIX), True).otherwise(False)


def total_amount(quantity: str = "quantity", unit_price: str = "unit_price") -> Column:
    """Line amount, brought back to cents; fails on overflow instead of widening."""
    return (F.col(quantity) * F.col(unit_price)).cast("decimal(10,2)")


# Calendar columns of a timestamp; the week starts on Sunday = 0.
DATE_PARTS = {
    "day": F.dayofmonth,
    "month": F.month,
    "year": F.year,
    "weekday": lambda col: F.dayofweek(col) - 1,
}
