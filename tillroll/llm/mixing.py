"""Mixing sources to target weights with hash thresholds.

Every document has a hash; a source takes its documents below a threshold. The words of each
source are summed by the first bits of the hash, which shows the bucket its budget ends in; only
that bucket is looked at with more bits, until one hash value is left. The documents are then
filtered by comparison with their source's threshold: no sort, and nothing of the size of the
corpus in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import word_count
from tillroll.operators.keys import assign_dense_key
from tillroll.scratch import Scratch

WEIGHTS = (5.0, 2.0, 1.0)  # of the sources in turn, by code point, null last
SHARE = 1.5  # of all words, to be taken in sum
REPEATS = 2.0  # a source is taken this often at most
BUCKET_BITS = 10
HASH_BITS = 60  # a multiple of the bucket's
FILLS = 2  # further thresholds, for what the first leaves of the budget

_SOURCE = ["none", "source"]  # whether the source is missing, and its name


def _hash(doc_id: Column) -> Column:
    """Hash of an id and its text, without sign."""
    return F.xxhash64(doc_id.cast("string"), "text").bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def source_targets(sizes: DataFrame, scratch: Scratch, weights=WEIGHTS, share=SHARE, repeats=REPEATS) -> DataFrame:
    """``sizes(none, source, source_size)`` with the words each source is to give.

    Targets are proportional to the weights; those above ``repeats`` times their source stop
    there, and the rest is shared again until none is above. Every round is one small sum.
    """
    order = [F.col("none"), F.col("source")]
    ranked = assign_dense_key(sizes, order, "nth", scratch)
    names = F.array(*(F.lit(float(w)) for w in weights))
    weight = F.element_at(names, (F.pmod(F.col("nth") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = scratch.cut(
        ranked.select(*_SOURCE, "source_size", weight.alias("weight"), (repeats * F.col("source_size")).alias("most")),
        "weights",
    )
    total = share * float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    per_weight, stopped = 0.0, -1
    while True:
        above = F.col("most") <= per_weight * F.col("weight")
        row = ranked.agg(
            F.count_if(above).alias("n"),
            F.coalesce(F.sum(F.when(above, F.col("most"))), F.lit(0.0)).alias("full"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if row["n"] == stopped or not row["open"]:
            break
        stopped = row["n"]
        per_weight = (total - row["full"]) / row["open"]
    target = F.least(F.col("most"), per_weight * F.col("weight"))
    return ranked.select(*_SOURCE, "source_size", target.alias("target"))


def _threshold(rows: DataFrame, wanted: DataFrame, scratch: Scratch) -> DataFrame:
    """(none, source, limit, words): the documents of ``rows`` with a hash below ``limit`` hold
    ``words`` words, no more than ``wanted``; with the next one they would hold more.

    Level by level, the words before the bucket in which the budget ends are settled, and only
    that bucket is divided further, until it is one hash value.
    """
    state = scratch.cut(
        wanted.select(*_SOURCE, "wanted", F.lit(0).cast("long").alias("limit"), F.lit(0).cast("long").alias("words")),
        "level",
    )
    inside = rows.join(state.select(*_SOURCE), _SOURCE, "left_semi")
    for bits in range(BUCKET_BITS, HASH_BITS + 1, BUCKET_BITS):
        low = HASH_BITS - bits
        histogram = inside.groupBy(*_SOURCE, F.shiftright("hash", low).alias("bucket")).agg(
            F.sum("size").alias("own"), F.min("hash").alias("lo"), F.max("hash").alias("hi")
        )
        upto = F.sum("own").over(Window.partitionBy(*_SOURCE).orderBy("bucket"))
        summed = histogram.withColumn("upto", upto).join(state, _SOURCE)
        boundary = (
            summed.filter(F.col("words") + F.col("upto") > F.col("wanted"))
            .groupBy(*_SOURCE)
            .agg(F.min(F.struct("bucket", "upto", "own", "lo", "hi")).alias("b"))
        )
        # Without a boundary, all there is fits in.
        ends = histogram.groupBy(*_SOURCE).agg(F.sum("own").alias("own"))
        state = state.join(boundary, _SOURCE, "left").join(ends, _SOURCE, "left")
        missing = F.col("b").isNull()
        state = scratch.cut(
            state.select(
                *_SOURCE, "wanted",
                F.when(missing, 1 << HASH_BITS).otherwise(F.shiftleft("b.bucket", low)).alias("limit"),
                (F.col("words") + F.when(missing, F.coalesce("own", F.lit(0))).otherwise(F.col("b.upto") - F.col("b.own"))).alias("words"),
                (missing | (F.col("b.lo") == F.col("b.hi"))).alias("single"),
            ),
            "level",
        )
        open_ = state.filter("not single")
        if low == 0 or open_.isEmpty():
            return state.select(*_SOURCE, "limit", "words")
        edge = state.select(*_SOURCE, F.shiftright("limit", low).alias("bucket"))
        inside = scratch.cut(
            inside.withColumn("bucket", F.shiftright("hash", low))
            .join(edge, [*_SOURCE, "bucket"], "left_semi")
            .drop("bucket"),
            "boundary",
        )
        state = state.drop("single")


def _thresholds(slim: DataFrame, targets: DataFrame, scratch: Scratch) -> DataFrame:
    """``targets`` with the whole passes over each source, and thresholds for one more.

    The first threshold ends before the document in which the budget ends. What is left is
    filled from the rest, by thresholds for documents small enough: ``limits`` holds pairs of
    the largest size and the hash below which documents up to that size are taken.
    """
    passes = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0)).cast("long")
    state = targets.withColumn("passes", passes)
    state = state.withColumns(
        {
            "wanted": F.col("target") - F.col("passes") * F.col("source_size"),
            "limits": F.array(F.struct(F.col("source_size").alias("most"), F.lit(0).cast("long").alias("below"))),
        }
    )
    state = scratch.cut(state, "wanted")
    for _ in range(FILLS + 1):
        due = state.select(*_SOURCE, "wanted", "limits").filter("wanted >= 1")
        rows = slim.select(*_SOURCE, "hash", "size").join(due, _SOURCE)
        rows = rows.filter(~_below(F.col("limits")) & (F.col("size") <= F.col("wanted")) | (F.size("limits") == 1))
        found = _threshold(rows.drop("wanted", "limits"), due, scratch).withColumnRenamed("words", "got")
        state = state.join(found, _SOURCE, "left")
        most = F.when(F.size("limits") == 1, F.col("source_size")).otherwise(F.floor("wanted").cast("long"))
        step = F.array(F.struct(most.alias("most"), F.col("limit").alias("below")))
        state = state.withColumn("limits", F.when(F.col("limit").isNull(), F.col("limits")).otherwise(F.concat("limits", step)))
        state = state.withColumn("wanted", F.col("wanted") - F.coalesce("got", F.lit(0))).drop("limit", "got")
        state = scratch.cut(state, "wanted")
    return state.select(*_SOURCE, "source_size", "target", "passes", "limits")


def _below(limits: Column) -> Column:
    """Whether a document is taken by one of its source's thresholds."""
    return F.exists(limits, lambda x: (F.col("size") <= x["most"]) & (F.col("hash") < x["below"]))


def _keyed(docs: DataFrame, doc_id: str, source: str, *columns: Column) -> DataFrame:
    return docs.select(
        F.col(source).isNull().alias("none"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        _hash(F.col(doc_id)).alias("hash"),
        word_count("text").alias("size"),
        *columns,
    )


def _limited(slim: DataFrame, scratch: Scratch, **settings) -> DataFrame:
    sizes = scratch.cut(slim.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size")), "sources")
    targets = scratch.cut(source_targets(sizes, scratch, **settings), "targets")
    return scratch.cut(_thresholds(slim, targets, scratch), "thresholds")


def _taken(keyed: DataFrame, limits: DataFrame) -> DataFrame:
    copies = F.col("passes") + _below(F.col("limits")).cast("long")
    return (
        keyed.join(limits, _SOURCE)
        .withColumn("copies", copies)
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def mix(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", source: str = "source", **settings) -> DataFrame:
    """``docs`` with size, source_size, target, taken and copies, replacing columns of these names.

    A document is taken whole, ``copies`` times: once for every whole pass over its source, and
    once more if its hash is below one of the source's thresholds for its size. Sizes are words between ASCII blanks;
    a null text has none, a source without words takes nothing. A missing source is one of its
    own. Rows equal in id and text share their fate. Reruns agree, since hashes and sums do.
    """
    added = ["size", "source_size", "target", "taken", "copies"]
    others = [c for c in docs.columns if c not in added]
    slim = scratch.cut(_keyed(docs, doc_id, source), "sizes")
    keyed = _keyed(docs, doc_id, source, F.struct(*others).alias("_row"))
    return _taken(keyed, _limited(slim, scratch, **settings)).select("_row.*", *added)


def mixing_query(spark: SparkSession, folder: str) -> DataFrame:
    """The mix's numbers, from the documents' sizes alone."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    scratch = Scratch(spark)
    slim = scratch.cut(_keyed(docs, "doc_id", "source", F.col("doc_id")), "sizes")
    return _taken(slim, _limited(slim, scratch)).select("doc_id", "size", "source_size", "target", "taken")
