"""What several corpus operators share: content keys, output columns, connected components."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.scratch import Scratch

# Hashes are counted by so many bits at a time, and ranked once so few are left.
CELL_BITS, CELL = 12, 1 << 14
# Of a longer text of a training sample, so many characters are learned from.
TRAIN_CHARS = 1 << 18

# ASCII blanks: what separates words unless an operator says otherwise.
BLANKS = r"[\x20\x09-\x0D]+"


def content_key(text: Column | str) -> Column:
    """16 bytes that name a text; null counts as empty.

    Rows are joined back by it, so no row number has to survive a repeated task, and copies
    of one text are handled once.
    """
    column = F.col(text) if isinstance(text, str) else text
    return F.substring(F.unhex(F.sha2(F.coalesce(column, F.lit("")), 256)), 1, 16)


def word_count(text: Column | str) -> Column:
    """Number of words between ASCII blanks; null has none."""
    column = F.col(text) if isinstance(text, str) else text
    words = F.filter(F.split(F.coalesce(column, F.lit("")), BLANKS), lambda w: w != "")
    return F.size(words).cast("long")


def lots(texts: Sequence[bytes], most: int) -> Iterator[tuple[int, int]]:
    """(first, last) of runs of texts that hold about so many bytes, or one longer text."""
    first, size = 0, 0
    for n, text in enumerate(texts):
        if size and size + len(text) > most:
            yield first, n
            first, size = n, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def release_memory() -> None:
    """Give back what a worker holds but does not use: workers live on between the stages of a
    pipeline, side by side with those of the next."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def _hash_limits(slim: DataFrame, by: list[str], size: int) -> DataFrame:
    """(by, _limit): the ``size``-th smallest ``_hash`` of each group that has so many.

    Counts by the first bits of the hashes show the cell in which it lies; that cell is divided by
    the next bits, until it is small. Only the hashes of the last cell are ranked, so no task
    gets more of a group than its cells or ``CELL`` hashes, however many the group has.
    """
    rest = slim.select(*by, "_hash", F.lit(0).cast("long").alias("_below"))
    for shift in range(64 - CELL_BITS, 0, -CELL_BITS):
        cells = rest.groupBy(*by, "_below", F.shiftright("_hash", shift).alias("_cell")).agg(F.count(F.lit(1)).alias("_k"))
        earlier = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        before = F.col("_below") + F.coalesce(F.sum("_k").over(earlier), F.lit(0))
        edges = cells.withColumn("_before", before).filter((F.col("_before") < size) & (F.col("_before") + F.col("_k") >= size))
        # One row for each group.
        edges = F.broadcast(edges.select(*(F.col(c).alias(f"_of_{c}") for c in by), "_cell", "_before", "_k"))
        inside = F.shiftright("_hash", shift) == F.col("_cell")
        for c in by:
            inside = inside & (F.col(c) == F.col(f"_of_{c}"))
        joined = rest.drop("_below").join(edges, inside).select(*by, "_hash", F.col("_before").alias("_below"), "_k")
        rest = joined.drop("_k")
        if (joined.agg(F.max("_k")).first()[0] or 0) <= CELL:
            break
    nth = F.row_number().over(Window.partitionBy(*by).orderBy("_hash"))
    return rest.withColumn("_nth", nth + F.col("_below")).filter(F.col("_nth") == size).select(*by, F.col("_hash").alias("_limit"))


def hash_sample(docs: DataFrame, hashed: Column, by: list[str], size: int, groups: int) -> DataFrame:
    """Rows of ``docs`` for training: of each group of the columns ``by`` (none may be null), those
    with the ``size`` smallest different hashes, one row for each hash.

    At most ``groups`` groups, the most frequent ones, take part. Only hashes are counted; the
    limits, one number per group, then filter the rows.
    """
    slim = docs.select(*by, hashed.alias("_hash")).groupBy(*by, "_hash").agg(F.count(F.lit(1)).alias("_n"))
    limits = _hash_limits(slim, by, size)
    if by:
        frequent = slim.groupBy(*by).agg(F.sum("_n").alias("_n")).orderBy(F.desc("_n"), *by).limit(groups)
        limits = frequent.join(limits, by, "left")
    within = F.lit(False)
    found = limits.collect()  # bounded by groups
    if not by and not found:
        within = F.lit(True)  # fewer than ``size``
    for row in found:
        condition = F.lit(True) if row["_limit"] is None else hashed <= F.lit(row["_limit"])
        for c in by:
            condition = condition & (F.col(c) == F.lit(row[c]))
        within = within | condition
    picked = docs.filter(within).withColumn("_hash", hashed)
    return picked.dropDuplicates([*by, "_hash"]).drop("_hash")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges(u, v)``; the root is the component's least node.

    Alternates large-star and small-star steps: every node points its neighbours to the least
    one it knows, which ends in stars after a logarithmic number of rounds. Each round is one
    grouped minimum and one join on small rows, cut to shared storage.
    """
    stars = scratch.cut(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    while True:
        # Large star: neighbours above a node go to the least node around it.
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: the neighbours below a node, and itself, go to the least of them.
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        stars = scratch.cut(small, "stars")
        # Done when all are stars: no node is both at a rim and a centre.
        centres = stars.select(F.col("v").alias("u")).distinct()
        if stars.select("u").join(centres, "u", "left_semi").isEmpty():
            break
    roots = stars.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
