"""Near-duplicate fingerprints by anchor points of a covering code.

A document's fingerprint has one bit for each bit of its shingle hashes, by majority. Two bands of
23 bits of a fingerprint are covered by the binary Golay code each: every word of 23 bits is within
3 of exactly one code word. A pair of code words is an anchor. A fingerprint's home is the anchor
nearest in both bands; it is sent to every anchor that lies within the covering radius plus the
threshold of it, where what exceeds the radius in both bands together is at most the threshold.
If two fingerprints differ in no more bits than that, either one is sent to the other's home, so
comparing homes with visitors at each anchor finds every link, on all 64 bits.

Anchors that many fingerprints meet at are compared in tiles of bounded size by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import components
from tillroll.llm.near_dup import whole_groups
from tillroll.scratch import Scratch

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42

# Fixed value: generator polynomial of the binary Golay code of length 23, dimension 12.
GENERATOR = 0b110001110101
LENGTH, CHECKS, RADIUS = 23, 11, 3
BANDS = 2
ANCHOR_BITS = BANDS * (LENGTH - CHECKS)

HOME_TILE, VISITOR_TILE = 1 << 11, 1 << 14  # rows of a tile
AT_ONCE = 1 << 20  # pairs compared at once
PIECE_BYTES = 1 << 20
FINGERPRINTS = 1 << 14  # whose anchors are listed at once

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"


# -- fingerprints ----------------------------------------------------------------------------


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The lowered words of a text between ASCII blanks, a piece of bounded size at a time."""
    start = 0
    while start < len(text):
        end = start + PIECE_BYTES
        while end < len(text) and text[end] not in _BLANKS:
            end += 1
        yield text[start:end].translate(_LOWER).split()
        start = end


def fingerprint(text: bytes | None, size: int = SHINGLE_WORDS) -> int:
    """The majority of the bits of all shingles' hashes; zero without words."""
    votes, total, carry = np.zeros(64, np.int64), 0, []

    def count(words: list[bytes], k: int) -> None:
        nonlocal votes, total
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1].tolist()
        hashes = [xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends[k - 1 :].tolist(), strict=True)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(0, dtype=np.int64)
        total += len(hashes)

    for words in _words(text or b""):
        words = carry + words
        if len(words) >= size:
            count(words, size)
        carry = words[-(size - 1) :] if size > 1 and len(words) >= size else words if len(words) < size else []
    if not total and carry:
        count(carry, len(carry))
    return int(np.packbits(2 * votes > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fingerprint) of every document, the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(np.array([fingerprint(t, size) for t in batch], np.uint64).view(np.int64))

    return docs.select(F.col(doc_id).alias("id"), of_texts.asNondeterministic()(F.col(text).cast("binary")).alias("fingerprint"))


# -- anchors ---------------------------------------------------------------------------------


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainders of words of 23 bits by the generator."""
    rest = words.astype(np.int64)
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - CHECKS)), rest)
    return rest


@lru_cache(maxsize=4)
def _patterns(excess: int) -> tuple[np.ndarray, np.ndarray]:
    """Error patterns that reach the code words at the radius plus ``excess`` (at most the radius
    for none), sorted by syndrome, and where those of each syndrome start."""
    weights = range(RADIUS + 1) if excess == 0 else [RADIUS + excess]
    words = np.array([sum(1 << i for i in at) for w in weights for at in combinations(range(LENGTH), w)], np.int64)
    syndromes = _syndrome(words)
    order = np.argsort(syndromes, kind="stable")
    return words[order], np.searchsorted(syndromes[order], np.arange((1 << CHECKS) + 1))


def _bands(prints: np.ndarray) -> list[np.ndarray]:
    mask = np.uint64((1 << LENGTH) - 1)
    return [(prints >> np.uint64(LENGTH * b) & mask).astype(np.int64) for b in range(BANDS)]


def _homes(prints: np.ndarray) -> np.ndarray:
    """The anchor nearest to each fingerprint in both bands."""
    home = np.zeros(len(prints), np.int64)
    for band in _bands(prints):
        errors, first = _patterns(0)  # one for each syndrome: the code is perfect
        home = home << (LENGTH - CHECKS) | (band ^ errors[first[_syndrome(band)]]) >> CHECKS
    return home


def _visits(prints: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place of the fingerprint, anchor) for every anchor but homes within radius plus threshold."""
    one, two = _bands(prints)
    s_one, s_two = _syndrome(one), _syndrome(two)
    for e in range(threshold + 1):
        for f in range(threshold + 1 - e):
            if e + f == 0:
                continue
            (errors_one, at_one), (errors_two, at_two) = _patterns(e), _patterns(f)
            n_one, n_two = at_one[s_one + 1] - at_one[s_one], at_two[s_two + 1] - at_two[s_two]
            counts = n_one * n_two
            who = np.repeat(np.arange(len(prints)), counts)
            k = np.arange(len(who)) - np.repeat(np.cumsum(counts) - counts, counts)
            i, j = np.divmod(k, n_two[who])
            code_one = (one[who] ^ errors_one[at_one[s_one[who]] + i]) >> CHECKS
            code_two = (two[who] ^ errors_two[at_two[s_two[who]] + j]) >> CHECKS
            yield who, code_one << (LENGTH - CHECKS) | code_two


def _frames(prints: np.ndarray, anchors: np.ndarray, home: bool) -> pa.RecordBatch:
    rows = [pa.array(anchors.astype(np.int32)), pa.array(prints.view(np.int64)), pa.array(np.full(len(anchors), home))]
    return pa.RecordBatch.from_arrays(rows, names=["anchor", "fingerprint", "home"])


def _at_homes(prints: DataFrame) -> DataFrame:
    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            own = frame.column(0).to_numpy().view(np.uint64)
            yield _frames(own, _homes(own), True)

    return prints.select("fingerprint").mapInArrow(batches, "anchor int, fingerprint long, home boolean")


def _inhabited(homes: DataFrame) -> np.ndarray:
    """Which anchors are some fingerprint's home: one bit for each anchor there is, 2 MB."""
    bits = homes.groupBy(F.bitmap_bucket_number("anchor").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("anchor")).alias("bits")
    )
    found = np.zeros((1 << ANCHOR_BITS) + (1 << 15), bool)
    for row in bits.collect():  # at most one row for 32,768 anchors
        # Bits of a bucket stand for the numbers from 32,768 * (bucket - 1) + 1 on, or from 0 for none.
        bits_of = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")
        at = np.flatnonzero(bits_of)
        numbers = at if row["bucket"] == 0 else (row["bucket"] - 1) * (1 << 15) + at + 1
        found[numbers] = True
    return np.packbits(found[: 1 << ANCHOR_BITS])


def _meetings(prints: DataFrame, threshold: int, scratch: Scratch) -> DataFrame:
    """(anchor, fingerprint, home): every fingerprint at its home, and wherever it visits another's."""
    homes = scratch.cut(_at_homes(prints), "homes")
    inhabited = prints.sparkSession.sparkContext.broadcast(_inhabited(homes))

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = inhabited.value
        for frame in frames:
            every = frame.column(0).to_numpy().view(np.uint64)
            for start in range(0, len(every), FINGERPRINTS):
                own = every[start : start + FINGERPRINTS]
                for who, anchors in _visits(own, threshold):
                    met = (bits[anchors >> 3] >> (7 - (anchors & 7)) & 1).astype(bool)
                    yield _frames(own[who[met]], anchors[met], False)

    visits = prints.select("fingerprint").mapInArrow(batches, "anchor int, fingerprint long, home boolean")
    return scratch.cut(homes.unionByName(visits), "meetings")


# -- links -----------------------------------------------------------------------------------


def _tiled(meetings: DataFrame) -> DataFrame:
    """(tile, fingerprint, home): an anchor is one tile, or as many as its blocks of homes and of
    visitors make; each row goes to all tiles of its block."""
    sizes = meetings.groupBy("anchor").agg(F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("visitors"))
    blocks = sizes.select(
        "anchor",
        F.ceil(F.col("homes") / HOME_TILE).alias("h"),
        F.ceil((F.col("homes") + F.col("visitors")) / VISITOR_TILE).alias("v"),
    )
    large = blocks.filter("h > 1 OR v > 1")
    rows = meetings.join(large, "anchor", "left").na.fill(1, ["h", "v"])
    own_h = F.pmod(F.xxhash64("fingerprint", F.lit(1)), F.col("h"))
    own_v = F.pmod(F.xxhash64("fingerprint", F.lit(2)), F.col("v"))
    every = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    tile = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    as_home = F.when(F.col("home"), F.transform(every(F.col("v")), lambda j: F.struct(tile(own_h, j).alias("t"), F.lit(True).alias("as_home"))))
    # A home also meets the other homes of its anchor.
    as_visitor = F.transform(every(F.col("h")), lambda i: F.struct(tile(i, own_v).alias("t"), F.lit(False).alias("as_home")))
    none = F.array().cast("array<struct<t:struct<i:bigint,j:bigint>,as_home:boolean>>")
    placed = rows.select("anchor", "fingerprint", F.explode(F.concat(F.coalesce(as_home, none), as_visitor)).alias("x"))
    return placed.select("anchor", "x.t.i", "x.t.j", "fingerprint", F.col("x.as_home").alias("home"))


def _near(homes: np.ndarray, visitors: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all homes and greater visitors that differ in at most the threshold's bits."""
    step = max(1, AT_ONCE // max(1, len(visitors)))
    found = []
    for start in range(0, len(homes), step):
        part = homes[start : start + step, None]
        a, b = np.nonzero((np.bitwise_count(part ^ visitors[None, :]) <= threshold) & (part < visitors[None, :]))
        found.append((a + start, b))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges to each value's least reachable value: as many as there are values, at most."""
    values, places = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = places[: len(u)], places[len(u) :]
    head = np.arange(len(values))
    while (head[a] != head[b]).any():
        lower = np.minimum(head[a], head[b])
        np.minimum.at(head, head[a], lower)
        np.minimum.at(head, head[b], lower)
        while (head[head] != head).any():
            head = head[head]
    apart = head != np.arange(len(values))
    return values[head[apart]], values[apart]


def links(prints: DataFrame, scratch: Scratch, threshold: int = MAX_BITS) -> DataFrame:
    """Edges (u, v) between distinct fingerprints, enough to connect all that differ in at most
    ``threshold`` bits one by one, and none between others' components."""
    placed = _tiled(_meetings(prints, threshold, scratch)).withColumn("tile", F.xxhash64("anchor", "i", "j"))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts in whole_groups(frames, "tile"):
            own, home = frame["fingerprint"].to_numpy(np.int64).view(np.uint64), frame["home"].to_numpy(bool)
            sizes = np.diff(starts)
            tile = np.repeat(np.arange(len(sizes)), sizes)
            homes_of = np.bincount(tile[home], minlength=len(sizes))
            pairs = homes_of * (sizes - homes_of)
            us, vs = [], []
            small = pairs <= AT_ONCE // 64
            # Small tiles many at a time: each home with all visitors of its tile.
            lots = np.cumsum(np.where(small, pairs, 0)) // AT_ONCE
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(lots)) + 1, [len(sizes)]))
            visitors = np.flatnonzero(~home)
            first_visitor = np.searchsorted(visitors, starts)
            n_visitors = sizes - homes_of
            for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                who = starts[first] + np.flatnonzero(home[starts[first] : starts[last]])
                who = who[small[tile[who]]]
                counts = n_visitors[tile[who]]
                a = np.repeat(who, counts)
                k = np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts)
                b = visitors[np.repeat(first_visitor[tile[who]], counts) + k] if len(a) else a
                near = (own[a] < own[b]) & (np.bitwise_count(own[a] ^ own[b]) <= threshold)
                us.append(own[a[near]])
                vs.append(own[b[near]])
            for t in np.flatnonzero(~small).tolist():
                inside = slice(starts[t], starts[t + 1])
                mine, others = own[inside][home[inside]], own[inside][~home[inside]]
                a, b = _near(mine, others, threshold)
                us.append(mine[a])
                vs.append(others[b])
            u, v = spanning(np.concatenate(us), np.concatenate(vs))
            if len(u):
                yield pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    dealt = placed.select("tile", "fingerprint", "home").repartition("tile").sortWithinPartitions("tile")
    return scratch.cut(dealt.mapInPandas(compare, "u long, v long"), "links")


def near_prints(
    docs: DataFrame,
    scratch: Scratch,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """(id, fingerprint, component_id) of every document.

    Words stand between ASCII blanks, A-Z lowered; shingles of ``shingle_words`` words count as
    often as they occur, and a shorter text is one shingle. A text that is null or has no word has
    fingerprint zero and is linked like any other. Documents are linked if their fingerprints
    differ in at most ``max_bits`` bits (3 at most); ``component_id`` is the smallest id reachable that is not
    null, null if there is none. Repeated rows are documents; other columns are not read. Long
    texts are hashed in pieces, an empty table gives no rows.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be from 0 to 3")
    rows = scratch.cut(fingerprints(docs, doc_id, text, shingle_words), "fingerprints")
    distinct = scratch.cut(rows.groupBy("fingerprint").agg(F.min("id").alias("id")), "distinct")
    roots = components(links(distinct, scratch, max_bits), scratch).withColumnRenamed("node", "fingerprint")
    placed = distinct.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    placed = scratch.cut(placed, "placed")
    least = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    found = placed.select("fingerprint", "root").join(least, "root").drop("root")
    return rows.join(found, "fingerprint").select("id", "fingerprint", "component_id")


def simhash_query(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the table with its fingerprint in hexadecimal and its component."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = near_prints(docs, Scratch(spark))
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
