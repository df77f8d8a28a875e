"""First rows of a group.

``row_number() <= n`` lets Spark cut every group to ``n`` rows in each task before the
shuffle, so a group that holds a third of the input sends at most ``n`` rows per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.schemas import DEDUPE_KEYS, DEDUPE_ORDER


# Parts that a group is ranked in first, if Spark would not cut it before the shuffle.
SALTS = 64


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, rank: str | None = None
) -> DataFrame:
    """The first ``n`` rows of each group in ``order``; missing keys form a group.

    Give ``order`` enough columns to decide every tie. ``rank`` names a column for the
    position in the group. Beyond the ``n`` up to which Spark cuts groups early, each group is
    first ranked in parts, so that no task gets more than ``SALTS * n`` rows of it.
    """
    if n < 1:
        raise ValueError("n must be positive")
    column = rank or "_rank"
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
        in_part = F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order))
        df = salted.withColumn("_in_part", in_part).filter(F.col("_in_part") <= n).drop("_salt", "_in_part")
    ranked = df.withColumn(column, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    first = ranked.filter(F.col(column) <= n)
    return first if rank else first.drop(column)


def dedupe(
    df: DataFrame, keys: Iterable[str] = DEDUPE_KEYS, order: Iterable[str] = DEDUPE_ORDER
) -> DataFrame:
    """One row per key, missing key parts being equal; the survivor is the first in ``order``,
    missing values last, so it does not change from run to run."""
    return top_n_per_group(df, list(keys), [F.asc_nulls_last(c) for c in order])
