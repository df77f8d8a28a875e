"""Dimensions of the star schema, each from one scan of the valid order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import DATE_PARTS
from tillroll.operators import assign_dense_key, extend_dense_key, top_n_per_group
from tillroll.scratch import Scratch


def country_counts(valid: DataFrame) -> DataFrame:
    """Order lines per customer and country, no country being one of them."""
    return valid.groupBy("customer_id", "country").agg(F.count(F.lit(1)).alias("orders_count"))


def customer_main_country(valid: DataFrame) -> DataFrame:
    """The country with most lines of each customer; the first by name on a tie."""
    order = [F.desc("orders_count"), F.asc_nulls_last("country")]
    return top_n_per_group(country_counts(valid), ["customer_id"], order).select(
        "customer_id", "country"
    )


def customer_invoice_span(valid: DataFrame) -> DataFrame:
    return valid.groupBy("customer_id").agg(
        F.min("invoice_date").alias("first_invoice"), F.max("invoice_date").alias("last_invoice")
    )


def build_dim_customer(valid: DataFrame) -> DataFrame:
    """Main country and first and last invoice per customer.

    The lines are counted once per customer and country, which leaves few rows; country and
    span both come from those, instead of two scans and a join.
    """
    per_country = valid.groupBy("customer_id", "country").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("invoice_date").alias("first"),
        F.max("invoice_date").alias("last"),
    )
    # min_by takes the smallest: most lines, then a present country, then its name.
    preference = F.struct(-F.col("n"), F.col("country").isNull(), F.col("country"))
    return per_country.groupBy("customer_id").agg(
        F.min_by("country", preference).alias("country"),
        F.min("first").alias("first_invoice"),
        F.max("last").alias("last_invoice"),
    )


def description_counts(valid: DataFrame) -> DataFrame:
    """Order lines per product and description, no description being one of them."""
    return valid.groupBy("stock_code", "description").agg(F.count(F.lit(1)).alias("cnt"))


def build_dim_product(valid: DataFrame) -> DataFrame:
    """The description with most lines of each product; the first by text on a tie."""
    order = [F.desc("cnt"), F.asc_nulls_last("description")]
    return top_n_per_group(description_counts(valid), ["stock_code"], order).select(
        "stock_code", "description"
    )


def distinct_dates(valid: DataFrame) -> DataFrame:
    """Every invoice time with its calendar columns; one row without a time if any line
    lacks it. Only the time itself is shuffled."""
    times = valid.select("invoice_date").distinct()
    return times.withColumns({name: part("invoice_date") for name, part in DATE_PARTS.items()})


def build_dim_date(valid: DataFrame, scratch: Scratch) -> DataFrame:
    order = [F.asc_nulls_last("invoice_date")]
    return assign_dense_key(distinct_dates(valid), order, "invoice_date_id", scratch, "int")


def extend_dim_date(dim_date: DataFrame, valid: DataFrame, scratch: Scratch) -> DataFrame:
    """``dim_date`` with the dates of ``valid`` it lacks. Known dates keep their keys, so facts
    that refer to them stay right; new ones go on from the highest, in their order."""
    order = [F.asc_nulls_last("invoice_date")]
    return extend_dense_key(dim_date, distinct_dates(valid), ["invoice_date"], order, "invoice_date_id", scratch, "int")
