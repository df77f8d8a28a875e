"""Raw and staging tables: text rows, typed rows, valid rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll.operators import (
    cast_strict,
    dedupe,
    normalize_nulls,
    required_keys,
    split_casts,
    standardize_text,
)
from tillroll.schemas import ORDER_COLUMNS, TYPED_COLUMNS
from tillroll.scratch import Scratch


def build_raw(lines: DataFrame) -> DataFrame:
    """Order lines as text, missing values as NULL. No shuffle."""
    return normalize_nulls(lines.select(*ORDER_COLUMNS))


def build_clean(raw: DataFrame, timestamp_format: str | None = None) -> DataFrame:
    """Standardised text and typed values; a value of the wrong form fails. No shuffle."""
    tidy = standardize_text(raw.select(*ORDER_COLUMNS))
    return cast_strict(tidy, TYPED_COLUMNS, timestamp_format)


def split_clean(raw: DataFrame, scratch: Scratch, timestamp_format: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of ``build_clean`` that can be cast, and the others with their faults. The raw
    rows are read once. No shuffle."""
    tidy = standardize_text(raw.select(*ORDER_COLUMNS))
    return split_casts(tidy, TYPED_COLUMNS, scratch, timestamp_format)


def build_valid(clean: DataFrame) -> DataFrame:
    """Rows with all required keys, one per set of duplicates. One shuffle."""
    return dedupe(required_keys(clean.select(*ORDER_COLUMNS)))
