"""Removal of repeated byte strings by a hash-compared suffix sort.

1. Anchors. Of every stretch of ``LENGTH`` bytes (a window), the ``GRAM`` bytes with the least
   hash are its anchor. Equal windows have equal anchors at equal offsets, so only windows whose
   anchor occurs more than once are looked at further.
2. Classes. An anchor's windows are consecutive; what they cover is its region. Equal regions
   form a class, by a grouped count. All windows of a class of two or more are repeated.
3. Suffix sort. The classes of one anchor are compared at the offsets where they differ: their
   suffixes are merge-sorted, a comparison being a binary search over prefix polynomial hashes
   for the common extension. Neighbours with ``LENGTH`` bytes in common are repeated, as far as
   they go on; every such run is verified byte by byte. Anchors with hundreds of classes have
   their windows compared by 128-bit hash instead, which takes time in proportion to their number;
   beyond what one task should hold, in rows that Spark counts.

Texts are matched by content key, so copies of a whole text are told apart by their number only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import content_key
from tillroll.scratch import Scratch

LENGTH = 400
GRAM = 64
PIECE = 1 << 18  # windows of a long text that are hashed at once
SORT_CLASSES = 192  # classes of an anchor whose suffixes are sorted
GROUP_CLASSES = 16_384  # classes of an anchor that one task compares
LOT_BYTES = 1 << 20  # contexts that are sorted at once
_PLACE_BITS = 20  # of a place within a piece

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


class _Hashes:
    """Prefix polynomial hashes of one byte string, modulo 2**64."""

    _powers: dict[int, np.ndarray] = {}

    def __init__(self, data: np.ndarray, seed: int = 0):
        table = np.random.default_rng(400 + seed).integers(0, 2**63, 256, dtype=np.uint64)
        size = len(data) + 1
        up, self.down = self._power(_ODD, size), self._power(_INVERSE, size)
        self.sums = np.zeros(size, np.uint64)
        np.cumsum(table[data] * up[: len(data)], out=self.sums[1:])

    @classmethod
    def _power(cls, base: int, size: int) -> np.ndarray:
        known = cls._powers.get(base)
        if known is None or len(known) < size:
            steps = np.full(max(size, 1 << 16), base, np.uint64)
            steps[0] = 1
            known = cls._powers[base] = np.cumprod(steps, dtype=np.uint64)
        return known

    def of(self, start: np.ndarray, size) -> np.ndarray:
        """Hashes of the strings of ``size`` bytes at ``start``."""
        return (self.sums[start + size] - self.sums[start]) * self.down[start]

    def ahead(self, a: np.ndarray, b: np.ndarray, most) -> np.ndarray:
        """Length of the common extension to the right, up to ``most``, by binary search."""
        low, high = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64) + most
        while (low < high).any():
            middle = (low + high + 1) >> 1
            equal = self.of(a, middle) == self.of(b, middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return low

    def behind(self, a: np.ndarray, b: np.ndarray, most) -> np.ndarray:
        """Length of the common extension to the left of ``a`` and ``b``."""
        low, high = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64) + most
        while (low < high).any():
            middle = (low + high + 1) >> 1
            equal = self.of(a - middle, middle) == self.of(b - middle, middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return low


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, from running minima of blocks."""
    count = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:count], ahead[width - 1 : width - 1 + count])


def anchors(text: bytes) -> Iterator[tuple[int, int, int, int]]:
    """(anchor hash, place, least offset, greatest offset): windows start at place - offset."""
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    for base in range(0, len(text) - LENGTH + 1, PIECE):
        data = np.frombuffer(text, np.uint8)[base : base + PIECE + LENGTH - 1]
        hashes = _Hashes(data)
        starts = np.arange(len(data) - GRAM + 1)
        grams = _mix(hashes.of(starts, GRAM))
        # The first of equal hashes wins, which is the same place in equal windows.
        least = _sliding_least((grams & ~mask) | starts.astype(np.uint64), LENGTH - GRAM + 1)
        place = (least & mask).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.append(first[1:], len(place)) - 1
        at = place[first]
        yield from zip(
            grams[at].view(np.int64).tolist(), (at + base).tolist(), (at - last).tolist(), (at - first).tolist(), strict=True
        )


ANCHORS = "key binary, anchor long, place int, lo int, hi int, region binary"
CLASS = ["anchor", "lo", "hi", "region"]


def _find_anchors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in ANCHORS.split(", ")]
    for frame in frames:
        rows: list[tuple] = []
        for key, text in zip(frame["key"], frame["text"], strict=True):
            for anchor, place, lo, hi in anchors(text):
                region = hashlib.blake2b(text[place - hi : place - lo + LENGTH], digest_size=16).digest()
                rows.append((key, anchor, place, lo, hi, region))
            if len(rows) > 50_000:
                yield pd.DataFrame(rows, columns=names)
                rows = []
        if rows:
            yield pd.DataFrame(rows, columns=names)


# -- the suffix sort --------------------------------------------------------------------------


class _Lot:
    """Contexts of whole groups, one after the other: ``LENGTH + hi - lo`` bytes each."""

    def __init__(self, frame: pd.DataFrame, seed: int):
        self.bytes = b"".join(frame["context"])
        self.hashes = _Hashes(np.frombuffer(self.bytes, np.uint8), seed)
        sizes = frame["context"].str.len().to_numpy(np.int64)
        self.base = np.cumsum(sizes) - sizes
        self.lo, self.hi = frame["lo"].to_numpy(np.int64), frame["hi"].to_numpy(np.int64)
        anchor = frame["anchor"].to_numpy()
        new = np.concatenate(([True], anchor[1:] != anchor[:-1]))
        self.group = np.cumsum(new) - 1
        self.first = np.flatnonzero(new)
        self.size = np.diff(np.append(self.first, len(anchor)))

    def at(self, member: np.ndarray, offset: np.ndarray) -> np.ndarray:
        """Where the window of ``member`` with this offset starts."""
        return self.base[member] + self.hi[member] - offset

    def precedes(self, a: np.ndarray, b: np.ndarray, ties: bool) -> np.ndarray:
        """Whether the suffix at ``a`` sorts before that at ``b``, by their first bytes."""
        common = self.hashes.ahead(a, b, LENGTH)
        data = np.frombuffer(self.bytes, np.uint8)
        inside = np.minimum(common, LENGTH - 1)
        return np.where(common == LENGTH, ties, data[a + inside] < data[b + inside])

    def sorted(self, starts: np.ndarray, lot: np.ndarray) -> np.ndarray:
        """Order of the suffixes within each ``lot``; lots are contiguous.

        Merge sort from the bottom: every element finds its place in the neighbouring run by
        binary search, all elements of all runs at a time.
        """
        order = np.arange(len(starts))
        begin = np.searchsorted(lot, lot, "left")
        end = np.searchsorted(lot, lot, "right")
        place = order - begin
        width = 1
        while width < (end - begin).max(initial=0):
            run = place // width
            left = run % 2 == 0
            other = begin + np.where(left, run + 1, run - 1) * width
            low = np.minimum(other, end)
            high = np.minimum(other + width, end)
            stop_at = low.copy()
            own = starts[order]
            while (low < high).any():
                middle = (low + high) >> 1
                busy = low < high
                probe = starts[order[np.where(busy, middle, 0)]]
                # Equal suffixes of the left run stay ahead of those of the right one.
                goes = np.zeros(len(own), bool)
                goes[busy & left] = self.precedes(probe[busy & left], own[busy & left], False)
                goes[busy & ~left] = self.precedes(probe[busy & ~left], own[busy & ~left], True)
                low = np.where(busy & goes, middle + 1, low)
                high = np.where(busy & ~goes, middle, high)
            target = begin + (run - ~left) * width + place % width + (low - stop_at)
            fresh = np.empty_like(order)
            fresh[target] = order
            order = fresh
            width *= 2
        return order

    def repeated(self, wanted: np.ndarray) -> list[list[tuple[int, int]]]:
        """For the ``wanted`` members, the offsets (from, to) of windows that another has too."""
        found: list[list[tuple[int, int]]] = [[] for _ in wanted]
        offset = np.where(wanted, self.hi, -1)
        while True:
            due = np.flatnonzero(offset >= self.lo)
            if not len(due):
                return found
            # All members of a group that have a window at an offset in question.
            asked = np.unique(np.stack([self.group[due], offset[due]], 1), axis=0)
            lot = np.repeat(np.arange(len(asked)), self.size[asked[:, 0]])
            inside = np.arange(len(lot)) - np.searchsorted(lot, lot, "left")
            member = self.first[asked[lot, 0]] + inside
            at_offset = asked[lot, 1]
            has = (self.lo[member] <= at_offset) & (at_offset <= self.hi[member])
            lot, member, at_offset = lot[has], member[has], at_offset[has]
            starts = self.at(member, at_offset)
            order = self.sorted(starts, lot)
            lot, member, at_offset, starts = lot[order], member[order], at_offset[order], starts[order]
            same = lot[1:] == lot[:-1]
            room = at_offset[1:] - np.maximum(self.lo[member[1:]], self.lo[member[:-1]])
            common = np.where(same, self.hashes.ahead(starts[:-1], starts[1:], np.where(same, room + LENGTH, 0)), 0)
            best = np.maximum(np.append(common, 0), np.append(0, common))
            after = np.append(common, 0) >= best
            partner = np.where(after, np.append(starts[1:], 0), np.append(0, starts[:-1]))
            asks = offset[member] == at_offset
            hit = asks & (best >= LENGTH)
            for m, d, e, a, b in zip(member[hit], at_offset[hit], best[hit], starts[hit], partner[hit], strict=True):
                if self.bytes[a : a + e] != self.bytes[b : b + e]:
                    raise _Collision
                found[m].append((int(max(self.lo[m], d - (e - LENGTH))), int(d)))
            following = np.full(len(offset), -1)
            following[member[hit]] = at_offset[hit] - (best[hit] - LENGTH) - 1
            alone = member[asks & (best < LENGTH)]
            if len(alone):
                following[alone] = self._next_chance(alone, offset[alone])
            offset = np.where(offset >= self.lo, following, -1)

    def _next_chance(self, member: np.ndarray, offset: np.ndarray) -> np.ndarray:
        """The greatest smaller offset at which another member can have an equal window.

        A later window shares its start with the end of this one, so it can only be equal where
        the ends of the two windows here have as much in common.
        """
        size = self.size[self.group[member]]
        asker = np.repeat(np.arange(len(member)), size)
        inside = np.arange(len(asker)) - np.repeat(np.cumsum(size) - size, size)
        other = self.first[self.group[member[asker]]] + inside
        d = offset[asker]
        chance = np.where(self.hi[other] < d, self.hi[other], -1)
        both = np.flatnonzero((self.lo[other] <= d) & (d <= self.hi[other]) & (other != member[asker]))
        ends = self.at(member[asker[both]], d[both]) + LENGTH
        common = self.hashes.behind(ends, self.at(other[both], d[both]) + LENGTH, LENGTH - 1)
        later = d[both] - (LENGTH - common)
        chance[both] = np.where(later >= self.lo[other[both]], later, -1)
        out = np.full(len(member), -1)
        np.maximum.at(out, asker, chance)
        return out


class _Collision(Exception):
    """Two strings of equal hash differ."""


RUNS = "anchor long, lo int, hi int, region binary, runs array<struct<lo:int,hi:int>>"


def _sort_groups(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of repeated windows of single classes; input is sorted by anchor."""
    rest: list[pd.DataFrame] = []
    size = 0
    for frame in frames:
        start = 0
        anchor = frame["anchor"].to_numpy()
        cuts = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
        lengths = np.cumsum(frame["context"].str.len().to_numpy())
        for cut in cuts.tolist():
            if size + lengths[cut - 1] - (lengths[start - 1] if start else 0) >= LOT_BYTES:
                yield from _sort_lot([*rest, frame.iloc[start:cut]])
                rest, size, start = [], 0, cut
        rest.append(frame.iloc[start:])
        size += int(lengths[-1] - (lengths[start - 1] if start else 0)) if len(frame) else 0
    if rest:
        yield from _sort_lot(rest)


def _sort_lot(frames: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    every = pd.concat(frames, ignore_index=True).drop_duplicates(CLASS, ignore_index=True)
    many = every.groupby("anchor")["anchor"].transform("size") > SORT_CLASSES
    for _, group in every[many].groupby("anchor"):
        yield _with_runs(group, _equal_windows(group))
    frame = every[~many].reset_index(drop=True)
    if not len(frame):
        return
    wanted = (frame["n"] == 1).to_numpy()
    seed = 0
    while True:
        try:
            found = _Lot(frame, seed).repeated(wanted)
            break
        except _Collision:
            seed += 1
    yield _with_runs(frame, found)


def _with_runs(frame: pd.DataFrame, found: list[list[tuple[int, int]]]) -> pd.DataFrame:
    out = frame[CLASS].copy()
    out["runs"] = [[{"lo": a, "hi": b} for a, b in runs] for runs in found]
    return out[[bool(runs) for runs in found]]


def _window_hashes(context: bytes, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """A digest of 128 bits of every window of a context, by falling offset, as two halves. No text
    is known for which two of them agree, as there is for polynomials modulo a power of two."""
    digests = b"".join(hashlib.blake2b(context[i : i + LENGTH], digest_size=16).digest() for i in range(hi - lo + 1))
    halves = np.frombuffer(digests, np.uint64).reshape(-1, 2)
    return halves[:, 0].copy(), halves[:, 1].copy()


def _equal_windows(group: pd.DataFrame) -> list[list[tuple[int, int]]]:
    """For the single classes of one anchor, the offsets (from, to) of windows that occur in
    another class."""
    lo, hi = group["lo"].to_numpy(np.int64), group["hi"].to_numpy(np.int64)
    hashes = [_window_hashes(c, a, b) for c, a, b in zip(group["context"], lo, hi, strict=True)]
    first, second = (np.concatenate(h) for h in zip(*hashes, strict=True))
    size = hi - lo + 1
    member = np.repeat(np.arange(len(group)), size)
    offset = np.repeat(hi + np.cumsum(size) - size, size) - np.arange(len(member))
    order = np.lexsort((second, first, offset))
    same = np.ones(len(order) - 1, bool)
    for column in (offset, first, second):
        same &= column[order[1:]] == column[order[:-1]]
    repeated = np.zeros(len(order), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    repeated &= (group["n"].to_numpy() == 1)[member]
    # Windows stand by member and falling offset, so runs are neighbours.
    at = np.flatnonzero(repeated)
    found: list[list[tuple[int, int]]] = [[] for _ in range(len(group))]
    if len(at):
        cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(member[at]) > 0)) + 1
        for a, b in zip(at[np.concatenate(([0], cut))], at[np.append(cut, len(at)) - 1], strict=True):
            found[member[a]].append((int(offset[b]), int(offset[a])))
    return found


def _windows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        hashes = [_window_hashes(*x) for x in zip(frame["context"], frame["lo"], frame["hi"], strict=True)]
        first, second = ([h[k].view(np.int64) for h in hashes] for k in (0, 1))
        yield frame[[*CLASS, "n"]].assign(first=first, second=second)


def _counted_windows(contexts: DataFrame) -> DataFrame:
    """As ``_sort_groups``, by counting windows: for anchors with any number of classes."""
    hashed = contexts.select(*CLASS, "n", "context").mapInPandas(
        _windows, "anchor long, lo int, hi int, region binary, n long, first array<long>, second array<long>"
    )
    windows = hashed.select(
        *CLASS, "n", F.posexplode(F.arrays_zip("first", "second")).alias("step", "h")
    ).select(*CLASS, "n", (F.col("hi") - F.col("step")).alias("offset"), F.col("h.first").alias("h1"), F.col("h.second").alias("h2"))
    name = ["anchor", "offset", "h1", "h2"]
    shared = windows.groupBy(*name).agg(F.sum("n").alias("all")).filter("all > 1").drop("all")
    found = windows.filter("n = 1").join(shared, name, "left_semi")
    offsets = F.array_agg(F.struct(F.col("offset").alias("lo"), F.col("offset").alias("hi")))
    return found.groupBy(*CLASS).agg(offsets.alias("runs"))


# -- the operator -----------------------------------------------------------------------------


def repeated_spans(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, spans): for every text with repeated strings, the byte ranges they cover."""
    texts = docs.select(content_key("text").alias("key"), F.col("text").cast("binary").alias("text"))
    long = texts.filter(F.octet_length("text") >= LENGTH)
    found = scratch.cut(long.mapInPandas(_find_anchors, ANCHORS), "anchors")
    repeated = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # Written first: between two plain shuffles, Spark can split the rows of a hot anchor.
    repeated = scratch.cut(repeated, "repeated")
    shared = scratch.cut(found.join(repeated, "anchor", "left_semi"), "shared")
    head = F.min(F.struct("key", "place"))
    classes = scratch.cut(shared.groupBy(*CLASS).agg(F.count(F.lit(1)).alias("n"), head.alias("head")), "classes")

    # Anchors of which some class is single and has others to be compared with.
    groups = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("classes"), F.min("n").alias("least"))
    open_groups = groups.filter("classes > 1 and least = 1").select("anchor", "classes")
    due = scratch.cut(classes.join(open_groups, "anchor"), "due")
    wanted = due.groupBy(F.col("head.key").alias("key")).agg(
        F.collect_list(F.struct(*CLASS, "n", "classes", F.col("head.place").alias("place"))).alias("classes")
    )
    once = long.join(wanted.select("key"), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    contexts = once.join(wanted, "key").select("text", F.explode("classes").alias("c")).select(
        "c.*",
        F.expr(f"substring(text, c.place - c.hi + 1, {LENGTH} + c.hi - c.lo)").alias("context"),
    )
    contexts = scratch.cut(contexts.drop("place"), "contexts")
    few = contexts.filter(F.col("classes") <= GROUP_CLASSES).drop("classes")
    dealt = few.repartition("anchor").sortWithinPartitions("anchor")
    runs = dealt.mapInPandas(_sort_groups, RUNS)
    many = _counted_windows(contexts.filter(F.col("classes") > GROUP_CLASSES))
    runs = scratch.cut(runs.unionByName(many), "runs")

    whole = classes.filter("n > 1").select(*CLASS, F.array(F.struct("lo", "hi")).alias("runs"))
    covered = shared.join(whole.unionByName(runs), CLASS).select("key", "place", F.explode("runs").alias("r"))
    span = F.struct(
        (F.col("place") - F.col("r.hi")).alias("start"), (F.col("place") - F.col("r.lo") + LENGTH).alias("end")
    )
    return covered.groupBy("key").agg(F.collect_set(span).alias("spans"))


CUT = T.StructType(
    [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept", T.BinaryType()),
    ]
)


def _cut(text: bytes | None, spans) -> tuple:
    if text is None:
        return None, None, None, None
    merged: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    kept, at = [], 0
    for start, end in merged:
        kept.append(text[at:start])
        at = end
    left = b"".join([*kept, text[at:]])
    return len(text), len(text) - len(left), len(merged), left


@F.pandas_udf(CUT)
def _cut_all(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    rows = [_cut(t, s) for t, s in zip(texts, spans, strict=True)]
    return pd.DataFrame(rows, columns=[f.name for f in CUT.fields], dtype=object)


def remove_repeats(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans and kept (the bytes that remain), replacing
    columns of these names.

    Texts are UTF-8 bytes; a null text is empty. A byte goes if a string of ``LENGTH`` bytes that
    covers it starts in another place too, of the same or another row; repeated rows are places
    of their own. Strings never cross documents and are judged on the input; all copies go. What
    is kept may start or end inside a character.
    """
    others = [c for c in docs.columns if c not in ("n_bytes", "n_removed", "n_spans", "kept")]
    spans = scratch.cut(repeated_spans(docs, scratch), "spans").select(
        F.col("key").alias("_key"), F.col("spans").alias("_spans")
    )
    rows = docs.select(*others, content_key("text").alias("_key")).join(spans, "_key", "left")
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    # Only texts with spans go through Python.
    cut = _cut_all.asNondeterministic()(F.when(F.col("_spans").isNotNull(), text), "_spans")
    return rows.withColumn("_c", cut).select(
        *others,
        F.octet_length(text).cast("long").alias("n_bytes"),
        *(F.coalesce(f"_c.{c}", F.lit(0)).cast("long").alias(c) for c in ("n_removed", "n_spans")),
        F.coalesce("_c.kept", text).alias("kept"),
    )


def suffix_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    removed = remove_repeats(docs, Scratch(spark))
    return removed.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
