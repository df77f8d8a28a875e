"""Dense surrogate keys 1..n in the order of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.scratch import Scratch

_POSITION = "_position"
# monotonically_increasing_id() holds the task number above this bit, the row number below.
_TASK_BITS = 33


def assign_dense_key(
    df: DataFrame, order: Sequence[Column], name: str, scratch: Scratch, dtype: str = "bigint"
) -> DataFrame:
    """Number the rows 1..n in ``order``, which must be unique per row.

    Equal to a global ``row_number()``, but no task ever sees more than its own range: the
    rows are shuffled once into ranges, sorted there, and written down with their range and
    position. The key is then the position plus the number of rows in earlier ranges; only
    that list, one row per range, is broadcast. Writing the ranges first keeps the key stable
    when tasks are repeated.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_POSITION, F.monotonically_increasing_id())
    )
    stored = scratch.cut(placed, name)
    task = F.shiftright(_POSITION, _TASK_BITS)
    row = F.col(_POSITION).bitwiseAND(F.lit((1 << _TASK_BITS) - 1))

    sizes = stored.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_task", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))

    return (
        stored.withColumn("_task", task)
        .join(F.broadcast(offsets), "_task")
        .withColumn(name, (row + F.col("_offset") + 1).cast(dtype))
        .select(name, *df.columns)
    )


def extend_dense_key(
    known: DataFrame, df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str, scratch: Scratch, dtype: str = "bigint"
) -> DataFrame:
    """``known``, whose rows are numbered 1..n, and the rows of ``df`` whose keys it lacks, numbered
    n+1.. in ``order``. Missing key parts are equal. Give a stored ``known``: it is read twice."""
    same = [F.col(f"_new.{k}").eqNullSafe(F.col(f"_known.{k}")) for k in keys]
    condition = same[0]
    for more in same[1:]:
        condition = condition & more
    fresh = df.alias("_new").join(known.select(*keys).alias("_known"), condition, "left_anti")
    numbered = assign_dense_key(fresh, order, "_number", scratch)
    highest = known.agg(F.max(name)).first()[0] or 0
    added = numbered.withColumn(name, (F.col("_number") + highest).cast(dtype))
    return known.select(name, *df.columns).unionByName(added.select(name, *df.columns))
