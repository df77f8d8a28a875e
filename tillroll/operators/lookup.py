"""Dimension lookups."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.quality import fk_violations
from tillroll.scratch import Scratch


def lookup(df: DataFrame, dimension: DataFrame, key: str, take: Iterable[str] = ()) -> DataFrame:
    """Inner join on one key, adding the columns ``take`` of the dimension.

    Only the key and those columns are read from the dimension. No join is forced: Spark
    broadcasts the dimension below its size limit and otherwise shuffles both sides, where
    adaptive execution splits a key that holds much of the input.
    """
    return df.join(dimension.select(key, *take), key)


def known_only(df: DataFrame, dimension: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """The rows whose key is in the dimension; nothing is taken from it.

    The distinct keys, far fewer than the rows, are compared with the dimension, and those it
    lacks are written down. The rows then lose these by an anti-join: as Spark knows how small
    that list is, it usually needs no shuffle of the rows; where the list is long, it is an
    ordinary join.
    """
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    unknown = scratch.cut(fk_violations(keys, dimension.select(key), {key: key}), f"unknown-{key}")
    return df.filter(F.col(key).isNotNull()).join(unknown, key, "left_anti")
