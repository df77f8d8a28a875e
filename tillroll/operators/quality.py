"""Constraints as queries: each returns the rows that break it, none for clean data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.cleanse import required_keys
from tillroll.schemas import Table


def _any(conditions: Iterable[Column]) -> Column:
    result = F.lit(False)
    for condition in conditions:
        result = result | condition
    return result


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or have a missing part, with their row count.

    Rows are counted before the shuffle, so a key with very many copies is no hot spot.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter((F.col("n_rows") > 1) | _any(F.col(k).isNull() for k in keys))


def distinct_dense_keys(df: DataFrame, key: str) -> DataFrame:
    """Exact number of distinct values of a key that is numbered without large gaps.

    Values are marked in bitmaps, so the shuffle carries about one bit per row.
    """
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(key))
    blocks = df.groupBy(F.bitmap_bucket_number(key).alias("block")).agg(bits.alias("bits"))
    return blocks.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n_distinct"))


def fk_violations(child: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Child rows whose reference (child column -> parent column) has no parent.

    As in SQL, a reference with a missing part is not checked.
    """
    wanted = required_keys(child, on)
    names = {parent_col: f"_parent_{i}" for i, parent_col in enumerate(on.values())}
    keys = parent.select(*(F.col(c).alias(n) for c, n in names.items()))
    matched = [F.col(c) == F.col(names[p]) for c, p in on.items()]
    return wanted.join(keys, matched, "left_anti")


def null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a NULL in one of the columns."""
    return df.filter(_any(F.col(c).isNull() for c in cols))


def _too_long(column: str, limit: int) -> Column:
    # Trailing blanks beyond the limit are cut by VARCHAR, not refused.
    return F.char_length(F.rtrim(F.col(column))) > limit


def length_violations(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows with a text longer than its limit."""
    return df.filter(_any(_too_long(c, n) for c, n in limits.items()))


def range_violations(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Rows with a value that is present but does not fit the type."""
    return df.filter(_any(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in types.items()))


def row_checks(table: Table) -> dict[str, Column]:
    """NOT NULL and length violations of a table as counts, for one pass next to a write."""
    checks = {f"{c} NOT NULL": F.count_if(F.col(c).isNull()) for c in table.required}
    for column, limit in table.max_lengths.items():
        checks[f"{column} VARCHAR({limit})"] = F.count_if(_too_long(column, limit))
    return checks
