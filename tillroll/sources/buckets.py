"""Rows stored in buckets of their join keys, so that joins need no shuffle.

Whoever joins a table of lines with the same dimension again and again pays for one shuffle, when
the buckets are written. A key that holds much of the lines is split: every line has a part next
to its key, and the dimension has a copy of each row for every part.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = "_part"
PARTS = 8


def write_buckets(df: DataFrame, keys: Sequence[str], buckets: int, path: str) -> DataFrame:
    """Write ``df`` to ``path`` in buckets of ``keys``, one sorted file for each; the frame that is
    returned tells Spark so, and nothing else in the catalog refers to it."""
    spark = df.sparkSession
    name = f"buckets_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *(F.col(k) for k in keys))
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay: the table is external
    return table


def line_buckets(lines: DataFrame, key: str, spread: Sequence[str], buckets: int, path: str, parts: int = PARTS) -> DataFrame:
    """Lines in buckets of a key and a part, which other columns (``spread``) decide."""
    part = F.pmod(F.xxhash64(*spread), F.lit(parts)).cast("int")
    return write_buckets(lines.withColumn(PART, part), [key, PART], buckets, path)


def dimension_buckets(dimension: DataFrame, key: str, buckets: int, path: str, parts: int = PARTS) -> DataFrame:
    """A dimension in the buckets of ``line_buckets``, with a row for every part."""
    every = dimension.withColumn(PART, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return write_buckets(every, [key, PART], buckets, path)


def join_buckets(lines: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Inner join of two tables in the same buckets: bucket by bucket, without a shuffle."""
    return lines.join(dimension.hint("merge"), [key, PART]).drop(PART)
