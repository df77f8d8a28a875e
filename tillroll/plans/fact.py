"""The sales fact and its dimension lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import return_flag, total_amount
from tillroll.operators import assign_dense_key, known_only, lookup
from tillroll.schemas import DEDUPE_KEYS
from tillroll.scratch import Scratch
from tillroll.sources.buckets import PART, join_buckets


# What the fact takes of a line.
LINE_COLUMNS = ("invoice_no", "stock_code", "invoice_date", "quantity", "customer_id", "unit_price")


def lookup_date_key(lines: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Adds the date key; lines without a time have none and are left out."""
    return lookup(lines, dim_date, "invoice_date", take=["invoice_date_id"])


def lookup_product(lines: DataFrame, dim_product: DataFrame, scratch: Scratch) -> DataFrame:
    """Lines of known products; the code itself is the key."""
    return known_only(lines, dim_product, "stock_code", scratch)


def lookup_customer(lines: DataFrame, dim_customer: DataFrame, scratch: Scratch) -> DataFrame:
    """Lines of known customers; the number itself is the key."""
    return known_only(lines, dim_customer, "customer_id", scratch)


def build_fact(
    valid: DataFrame,
    dim_date: DataFrame,
    dim_product: DataFrame,
    dim_customer: DataFrame,
    scratch: Scratch,
) -> DataFrame:
    """One row per valid line that all dimensions know, numbered in the order of the
    duplicate keys. Give stored tables: each is read more than once.

    The lines are filtered first and numbered, and get their date key last, so that finding the
    ranges of the numbering reads no join with dates. As the lines left have known times, that
    join drops none and leaves no gap in the numbers.
    """
    lines = valid.select(*LINE_COLUMNS)
    lines = known_only(lines, dim_date, "invoice_date", scratch)
    lines = lookup_product(lines, dim_product, scratch)
    lines = lookup_customer(lines, dim_customer, scratch)
    order = [F.asc_nulls_last(c) for c in DEDUPE_KEYS]
    numbered = lookup_date_key(assign_dense_key(lines, order, "fact_id", scratch), dim_date)
    return _measured(numbered, "fact_id")


def build_colocated_fact(
    lines: DataFrame, dim_date: DataFrame, dim_product: DataFrame, customers: DataFrame, scratch: Scratch
) -> DataFrame:
    """The fact without its number, from lines and customers in the same buckets
    (``sources.buckets``). No line is shuffled while the dates can be broadcast."""
    known = join_buckets(lines, customers.select("customer_id", PART), "customer_id")
    known = lookup_product(known, dim_product, scratch)
    return _measured(lookup_date_key(known, dim_date))


def _measured(lines: DataFrame, *first: str) -> DataFrame:
    return lines.select(
        *first,
        "invoice_no",
        "stock_code",
        "customer_id",
        "invoice_date_id",
        "quantity",
        "unit_price",
        total_amount().alias("total_amount"),
        return_flag().alias("return_flag"),
    )
