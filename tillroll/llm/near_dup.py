"""Near-duplicate documents by a chosen-path set similarity join.

Documents with equal shingle sets form a class, and classes are compared. In each of several
independent trees, a class goes down the paths named by randomly selected minwise tokens of its
set: similar sets share tokens, and so meet in a node. Small nodes are compared exhaustively on
full sets; large ones branch again. A pair at the threshold meets in one tree with a chance of
about 0.63 (0.37 three levels deep), so ``TREES`` trees miss few of them.

The first trees link most of each group. Afterwards only nodes that hold different components
are looked at, so a large group of near copies costs no square of its size.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import components, release_memory
from tillroll.scratch import Scratch

SHINGLE_WORDS = 5
MIN_PERCENT = 80
TOKENS = 64
FIRST_TREES = 2  # to link the bulk of each group
TREES = 18  # all of them
NODE_CLASSES = 3_000  # a node up to this size is compared exhaustively
BULK_CLASSES = 300  # nodes up to this size are compared many at a time
DEPTH = 3  # levels below which a node that is still large is compared in blocks
PIECE_BYTES = 1 << 20
PAIRS = 150_000  # pairs of sketches compared at once

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_POWERS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15 | 1, np.uint64), dtype=np.uint64)
_FACTORS = (np.random.default_rng(20).integers(0, 2**31, TOKENS, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]

CANDIDATE = "tree int, node long, class binary, label binary, other binary"
DESCRIBED = T.StructType(
    [
        T.StructField("class", T.BinaryType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("tokens", T.ArrayType(T.LongType())),
        T.StructField("sketch", T.BinaryType()),
    ]
)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the lowered words between ASCII blanks."""
    codes = np.frombuffer(text.translate(_LOWER), np.uint8)
    word = ~_BLANK[codes]
    steps = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
    starts, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    offsets = np.cumsum(lengths) - lengths
    chars = codes[word].astype(np.uint64) + np.uint64(1)
    place = np.arange(len(chars)) - np.repeat(offsets, lengths)
    # Words beyond the table of powers go on with another factor for every further stretch.
    power = _POWERS[place % len(_POWERS)] + (place // len(_POWERS)).astype(np.uint64)
    return _mix(np.add.reduceat(chars * power, offsets) ^ _mix(lengths.astype(np.uint64)))


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces of bounded size, cut at blanks."""
    start = 0
    while start < len(text):
        end = start + PIECE_BYTES
        while end < len(text) and not _BLANK[text[end]]:
            end += 1
        yield text[start:end]
        start = end


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """Hashes of the distinct ``size``-word shingles, ascending; all words if there are fewer."""
    parts = [_word_hashes(p) for p in _pieces(text or b"")]
    words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    if not len(words):
        return words
    size = min(size, len(words))
    count = len(words) - size + 1
    mixed = np.full(count, size, np.uint64)
    for k in range(size):
        mixed = _mix(mixed * np.uint64(0x9E3779B97F4A7C15) + words[k : k + count])
    return np.unique(mixed)


def _minwise(hashes: np.ndarray) -> np.ndarray:
    """For each factor, the hash of the shingle that it makes least (the first, if tied)."""
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(TOKENS, np.iinfo(np.uint32).max, np.uint32)
    tokens = np.full(TOKENS, hashes[0], np.uint64)
    for start in range(0, len(hashes), 8192):
        part = high[None, start : start + 8192] * _FACTORS
        at = part.argmin(1)
        value = part[np.arange(TOKENS), at]
        tokens = np.where(value < least, hashes[start + at], tokens)
        least = np.minimum(least, value)
    return tokens


def _describe(text: bytes | None, size: int) -> tuple:
    found = shingles(text, size)
    if not len(found):
        return None, 0, None, None
    name = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
    tokens = _minwise(found)
    return name, len(found), tokens.view(np.int64), tokens.astype(np.uint16).tobytes()


def _described(docs: DataFrame, doc_id: str, size: int) -> DataFrame:
    @F.pandas_udf(DESCRIBED)
    def describe(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([_describe(t, size) for t in batch], columns=[f.name for f in DESCRIBED.fields])
        release_memory()

    rows = docs.select(
        F.col(doc_id).alias("id"),
        F.xxhash64("text").alias("text_hash"),
        describe.asNondeterministic()(F.col("text").cast("binary")).alias("d"),
    )
    return rows.select("id", "text_hash", "d.*")


# -- nodes -----------------------------------------------------------------------------------


def whole_groups(frames: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Batches that hold whole groups of one key, with the places where groups start, and their
    length last; input is sorted by the key, and its batches may end anywhere."""
    rest: pd.DataFrame | None = None
    for frame in frames:
        if rest is not None:
            frame = pd.concat([rest, frame], ignore_index=True)
        keys = frame[key].to_numpy()
        starts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1)) if len(keys) else np.zeros(1, int)
        if len(starts) > 1:
            yield frame.iloc[: starts[-1]], starts
        rest = frame.iloc[starts[-1] :].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest, np.array([0, len(rest)])


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("node").sortWithinPartitions("node", "class")


def _likely(percent: int) -> int:
    """Equal tokens that a pair at the threshold has, but for about one in ten thousand pairs;
    more similar pairs are missed less."""
    share = percent / 100
    return max(1, int(TOKENS * share - 4 * (TOKENS * share * (1 - share)) ** 0.5))


def _ranges(lots: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, last) of each run of equal numbers."""
    cuts = np.concatenate(([0], np.flatnonzero(lots[1:] != lots[:-1]) + 1, [len(lots)]))
    yield from zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)


def _candidates(members: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Members of small nodes that have a partner of another label with many equal tokens, each
    with ``other``, one member for all that such pairs connect."""
    least = _likely(percent)

    def pick(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts in whole_groups(frames, "node"):
            sketch = np.frombuffer(b"".join(frame["sketch"]), np.uint16).reshape(len(frame), TOKENS)
            label = np.frombuffer(b"".join(frame["label"]), np.uint64).reshape(len(frame), 2)
            sizes = np.diff(starts)
            found, head = np.zeros(len(frame), bool), np.arange(len(frame))
            # All pairs of whole groups, so many at a time.
            bulk = np.where(sizes <= BULK_CLASSES, sizes, 0)
            lots = np.cumsum(bulk.astype(np.int64) ** 2) // PAIRS
            for first, last in _ranges(lots):
                size = np.repeat(bulk[first:last], sizes[first:last])
                start = np.repeat(starts[first:last], sizes[first:last])
                a = np.repeat(np.arange(starts[first], starts[last]), size)
                b = np.arange(len(a)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
                a, b = a[a < b], b[a < b]
                apart = (label[a] != label[b]).any(1)
                a, b = a[apart], b[apart]
                alike = np.concatenate(
                    [(sketch[a[k : k + PAIRS]] == sketch[b[k : k + PAIRS]]).sum(1) >= least for k in range(0, max(len(a), 1), PAIRS)]
                )
                a, b = a[alike], b[alike]
                found[a] = found[b] = True
                while (head[a] != head[b]).any():
                    lower = np.minimum(head[a], head[b])
                    np.minimum.at(head, a, lower)
                    np.minimum.at(head, b, lower)
            for start, end in zip(starts[:-1][sizes > BULK_CLASSES].tolist(), starts[1:][sizes > BULK_CLASSES].tolist(), strict=True):
                own = head[start:end]  # a view
                for i in range(start, end - 1):
                    apart = (label[i + 1 : end] != label[i]).any(1)
                    near = i + 1 + np.flatnonzero(apart & ((sketch[i + 1 : end] == sketch[i]).sum(1) >= least))
                    if len(near):
                        found[i] = found[near] = True
                        joined = np.unique(head[np.append(near, i)])
                        if len(joined) > 1:
                            own[np.isin(own, joined)] = joined[0]
            if found.any():
                other = frame["class"].to_numpy()[head[found]]
                yield frame.loc[found, ["tree", "node", "class", "label"]].assign(other=other)
        release_memory()

    rows = members.select("tree", "node", "class", "label").join(sketches, "class")
    return _dealt(rows).mapInPandas(pick, CANDIDATE)


def _spanning(names: list, labels: list, hashes: list, percent: int) -> list[tuple[bytes, bytes]]:
    """Edges that connect what similarity connects beyond the labels, from comparing each member
    with all others."""
    if len(names) < 2:
        return []
    sizes = np.array([len(h) for h in hashes])
    if len(names) == 2:
        common = len(np.intersect1d(*hashes, assume_unique=True))
        similar = labels[0] != labels[1] and 100 * common >= percent * (sizes.sum() - common)
        return [(names[0], names[1])] if similar else []
    numbers: dict = {}
    root = np.array([numbers.setdefault(x, len(numbers)) for x in labels])
    values, codes = np.unique(np.concatenate(hashes), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    edges = []
    for i in range(len(names)):
        if (root == root[0]).all():
            break
        own = np.zeros(len(values), np.int32)
        own[codes[starts[i] : starts[i] + sizes[i]]] = 1
        common = np.add.reduceat(own[codes], starts)
        for j in np.flatnonzero(100 * common >= percent * (sizes + sizes[i] - common)):
            if root[i] != root[j]:
                edges.append((names[i], names[j]))
                root[root == root[j]] = root[i]
    return edges


def _linked(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges between classes of one node with similar sets: enough to connect all that are
    linked, and none between what a label connects already."""

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts in whole_groups(frames, "node"):
            names, labels = frame["class"].to_list(), frame["label"].to_list()
            hashes = [np.frombuffer(s, np.uint64) for s in frame["set"]]
            edges: list[tuple[bytes, bytes]] = []
            for first, last in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                edges += _spanning(names[first:last], labels[first:last], hashes[first:last], percent)
            if edges:
                yield pd.DataFrame(edges, columns=["u", "v"])
        release_memory()

    rows = members.select("node", "class", "label").distinct().join(sets, "class")
    return _dealt(rows).mapInPandas(link, "u binary, v binary")


def _selected(tree: int, percent: int) -> list[int]:
    """Token places that the root of a tree branches by: one over the threshold on average."""
    draws = np.random.default_rng(1000 + tree).random(TOKENS)
    chosen = np.flatnonzero(draws < 100 / percent / TOKENS)
    return [int(i) for i in chosen] or [int(draws.argmin())]


def _places(percent: int) -> int:
    """Token places of all roots: so many nodes every class is in at first."""
    return sum(len(_selected(t, percent)) for t in range(TREES))


def _most_differences(places: int, percent: int) -> int:
    """So many of the places, or more, differ in a pair at the threshold only in one of ten
    thousand such pairs."""
    differ, tail = 1 - percent / 100, 1.0
    for k in range(places + 1):
        if tail <= 1e-4:
            return k
        tail -= math.comb(places, k) * differ**k * (1 - differ) ** (places - k)
    return places


def _first_nodes(classes: DataFrame, percent: int) -> DataFrame:
    nodes = [
        F.struct(F.lit(t).alias("tree"), F.xxhash64(F.lit(t), F.lit(i), F.element_at("tokens", i + 1)).alias("node"))
        for t in range(TREES)
        for i in _selected(t, percent)
    ]
    return classes.select("class", F.explode(F.array(*nodes)).alias("x")).select("x.tree", "x.node", "class")


def _branched(rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Rows of large nodes in their child nodes; the node's number selects the places."""
    places = F.filter(
        F.sequence(F.lit(1), F.lit(TOKENS)),
        lambda i: F.pmod(F.xxhash64(F.col("node"), i), F.lit(1_000_003)) < F.lit(1_000_003 * 100 / percent / TOKENS),
    )
    chosen = rows.join(classes.select("class", "tokens"), "class").withColumn("i", F.explode(places))
    return chosen.select(
        "tree", F.xxhash64("node", "i", F.element_at("tokens", F.col("i"))).alias("node"), "class", "label"
    )


def _mixed_nodes(rows: DataFrame) -> DataFrame:
    """Rows of nodes with more than one label, with the number of rows of the node, and of those
    that do not have its main label."""
    labels = rows.groupBy("node", "label").agg(F.count(F.lit(1)).alias("k"))
    sizes = labels.groupBy("node").agg(
        F.sum("k").alias("n"), F.max(F.struct("k", "label")).alias("main"), F.count(F.lit(1)).alias("labels")
    )
    mixed = sizes.filter("labels > 1").select("node", "n", (F.col("n") - F.col("main.k")).alias("minor"), F.col("main.label").alias("main"))
    return rows.join(mixed, "node")


def _blocks(rows: DataFrame) -> DataFrame:
    """Large nodes as small ones: blocks of minor labels with each other and with every block of
    the node's main label, which is linked within itself already."""
    per_block = max(1, NODE_CLASSES // 4)
    count = lambda k: F.greatest(F.lit(1), F.ceil(k / per_block)).cast("int")
    sides = rows.select(
        "tree", "node", "class", "label",
        (F.col("label") == F.col("main")).alias("major"),
        count(F.col("minor")).alias("minors"),
        count(F.col("n") - F.col("minor")).alias("majors"),
    )
    own = F.when(F.col("major"), F.pmod(F.xxhash64("class"), F.col("majors"))).otherwise(
        F.pmod(F.xxhash64("class"), F.col("minors"))
    )
    numbered = sides.withColumn("own", own.cast("int"))
    to_minor = F.transform(
        F.sequence(F.lit(0), F.col("minors") - 1),
        lambda i: F.when(F.col("major"), F.xxhash64("node", F.lit(True), i, "own")).otherwise(
            F.xxhash64("node", F.lit(False), F.least(i, F.col("own")), F.greatest(i, F.col("own")))
        ),
    )
    to_major = F.when(F.col("major"), F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("majors") - 1), lambda j: F.xxhash64("node", F.lit(True), "own", j))
    )
    pairs = numbered.withColumn("pair", F.explode(F.concat(to_minor, to_major)))
    return pairs.select("tree", F.col("pair").alias("node"), "class", "label")


def _branch_candidates(
    large: DataFrame, classes: DataFrame, sketches: DataFrame, percent: int, scratch: Scratch
) -> DataFrame:
    """Candidates from large nodes. They branch until they are small or hold one label; those
    with few members beside the main label have them compared with all others at once, which is
    less than a level of branches."""
    found = None
    for depth in range(DEPTH + 1):
        rows = scratch.cut(_mixed_nodes(large.select("tree", "node", "class", "label")), "large")
        small = F.col("n") <= NODE_CLASSES
        direct = small if depth < DEPTH else F.lit(False)
        deeper = ~small & (F.col("minor") > NODE_CLASSES // 4) if depth < DEPTH else F.lit(False)
        leaves = rows.filter(direct).select("tree", "node", "class", "label")
        leaves = leaves.unionByName(_blocks(rows.filter(~direct & ~deeper)))
        picked = scratch.cut(_candidates(leaves, sketches, percent), "leaves")
        found = picked if found is None else found.unionByName(picked)
        rest = rows.filter(deeper)
        if rest.isEmpty():
            return found
        large = _branched(rest, classes, percent)
    return found


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(class, set) of the wanted classes, from one text of each."""

    @F.pandas_udf(T.StructType([T.StructField("class", T.BinaryType()), T.StructField("set", T.BinaryType())]))
    def full(texts: pd.Series) -> pd.DataFrame:
        sets = [shingles(t, size).tobytes() for t in texts]
        return pd.DataFrame({"class": [hashlib.blake2b(s, digest_size=16).digest() for s in sets], "set": sets})

    hashes = classes.join(wanted, "class", "left_semi").select("text_hash").distinct()
    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text").join(hashes, "text_hash", "left_semi")
    one = texts.groupBy("text_hash").agg(F.first("text").alias("text"))
    return one.select(full.asNondeterministic()(F.col("text").cast("binary")).alias("s")).select("s.*")


def _labelled(members: DataFrame, edges: DataFrame | None, scratch: Scratch) -> DataFrame:
    """``members`` with the component of each class as its label; by itself without edges."""
    if edges is None:
        return members.withColumn("label", F.col("class"))
    labels = components(edges, scratch).select(F.col("node").alias("class"), F.col("root").alias("label"))
    known = members.drop("label").join(scratch.cut(labels, "labels"), "class", "left")
    return known.withColumn("label", F.coalesce("label", "class"))


def _verified(candidates: DataFrame, sets: DataFrame, known: DataFrame | None, percent: int, scratch: Scratch) -> DataFrame:
    """Edges between similar classes among the candidates of all nodes.

    What candidates connect falls into components; those of bounded size are compared in one
    place each, so that a set is moved once and not for each of its nodes. Members of larger
    components are compared node by node: in the first trees, and then where labels still meet.
    """
    links = candidates.select(F.col("class").alias("u"), F.col("other").alias("v"))
    placed = components(links, scratch).select(F.col("node").alias("class"), "root")
    sizes = placed.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    placed = scratch.cut(placed.join(sizes, "root"), "candidate-components")
    labels = candidates.select("class", "label").distinct()
    small = placed.filter(F.col("n") <= NODE_CLASSES).join(labels, "class").withColumnRenamed("root", "node")
    edges = scratch.cut(_linked(small, sets, percent), "links")
    large = candidates.join(placed.filter(F.col("n") > NODE_CLASSES), "class", "left_semi")
    large = scratch.cut(large.drop("other"), "large-components")
    if large.isEmpty():
        return edges
    first = _linked(large.filter(F.col("tree") < FIRST_TREES), sets, percent)
    edges = scratch.cut(edges.unionByName(first), "first-links")
    linked = edges if known is None else edges.unionByName(known)
    later = _labelled(large.filter(F.col("tree") >= FIRST_TREES), linked, scratch)
    more = _linked(_mixed_nodes(later), sets, percent)
    return scratch.cut(edges.unionByName(more), "all-links")


def near_duplicates(
    docs: DataFrame,
    scratch: Scratch,
    doc_id: str = "doc_id",
    shingle_words: int = SHINGLE_WORDS,
    min_percent: int = MIN_PERCENT,
) -> tuple[DataFrame, DataFrame]:
    """Rows (id, class, n_shingles) of all documents, and (class, root, component_id, first).

    Words stand between ASCII blanks, A-Z lowered. A document's set holds its distinct shingles
    of ``shingle_words`` words; with fewer words, all of them as one. Two documents are linked
    if 100 * common >= ``min_percent`` * united; components follow the links. ``component_id``
    is a component's smallest id that is not null, null if it has none; ``first`` marks the class
    that holds it (the smallest of these). A document without words has no class and no link.
    Repeated rows, with equal ids or none, are documents of one class.
    """
    rows = scratch.cut(_described(docs, doc_id, shingle_words), "described")
    classes = scratch.cut(
        rows.filter("class is not null")
        .groupBy("class")
        .agg(F.min("id").alias("id"), F.min("text_hash").alias("text_hash"), F.first("tokens").alias("tokens"), F.first("sketch").alias("sketch")),
        "classes",
    )
    sketches = classes.select("class", "sketch")
    nodes = _first_nodes(classes, min_percent)
    sizes = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = scratch.cut(sizes, "sizes")
    members = scratch.cut(_labelled(nodes.join(sizes, "node"), None, scratch), "members")
    found = _candidates(members.filter(F.col("n") <= NODE_CLASSES), sketches, min_percent)
    large = members.filter(F.col("n") > NODE_CLASSES)
    # Whoever is in so few large nodes meets every similar class in a small one.
    places = _places(min_percent)
    enough = places - _most_differences(places, min_percent)
    often = large.groupBy("class").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > enough)
    large = scratch.cut(large.join(often.drop("k"), "class", "left_semi"), "large-nodes")
    if large.isEmpty():
        candidates = scratch.cut(found, "candidates")
        sets = scratch.cut(_sets(docs, classes, candidates.select("class"), shingle_words), "sets")
        edges = _verified(candidates, sets, None, min_percent, scratch)
    else:
        # Large nodes in random parts, which links the bulk of a large group; other trees then
        # branch them where components meet.
        part = F.pmod(F.xxhash64("class", "tree"), F.ceil(2 * F.col("n") / NODE_CLASSES))
        parts = large.filter(F.col("tree") < FIRST_TREES).withColumn("node", F.xxhash64("node", part))
        parts = scratch.cut(_candidates(parts, sketches, min_percent), "part-candidates")
        found = scratch.cut(found, "small-candidates")
        sets = scratch.cut(
            _sets(docs, classes, found.select("class").unionByName(parts.select("class")), shingle_words), "sets"
        )
        bulk = scratch.cut(_linked(parts, sets, min_percent), "bulk-links")
        deep = _branch_candidates(
            _labelled(large.filter(F.col("tree") >= FIRST_TREES), bulk, scratch), classes, sketches, min_percent, scratch
        )
        late = deep.select("class").distinct().join(sets.select("class"), "class", "left_anti")
        sets = sets.unionByName(scratch.cut(_sets(docs, classes, late, shingle_words), "late-sets"))
        candidates = scratch.cut(found.unionByName(deep), "candidates")
        edges = bulk.unionByName(_verified(candidates, sets, bulk, min_percent, scratch))

    roots = components(edges, scratch).select(F.col("node").alias("class"), "root")
    placed = classes.select("class", "id").join(roots, "class", "left")
    placed = scratch.cut(placed.withColumn("root", F.coalesce("root", "class")), "placed")
    ids = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("class"))
    heads = placed.groupBy("root").agg(F.min(ids).alias("head"))
    found = placed.join(heads, "root").select(
        "class", "root", F.col("head.id").alias("component_id"), (F.col("class") == F.col("head.class")).alias("first")
    )
    return rows.select("id", "class", "n_shingles", "text_hash"), found


def drop_near_duplicates(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", **settings: int) -> DataFrame:
    """One document of each component, the one with the smallest id; rows equal to it in id and
    shingles are copies and go too. Documents without words stay."""
    rows, found = near_duplicates(docs, scratch, doc_id, **settings)
    # Texts are matched by hash; a class holds one text, or several that differ in blanks and case.
    picks = (
        rows.join(found.filter("first"), "class")
        .filter(F.col("id").eqNullSafe(F.col("component_id")))
        .groupBy("class")
        .agg(F.min("text_hash").alias("_hash"), F.first("component_id").alias("_id"))
    )
    chosen = docs.withColumn("_hash", F.xxhash64("text")).join(picks.drop("class"), "_hash")
    chosen = chosen.filter(F.col(doc_id).eqNullSafe(F.col("_id")))
    nth = F.row_number().over(Window.partitionBy("_hash").orderBy(doc_id))
    chosen = chosen.withColumn("_nth", nth).filter("_nth = 1")
    has_words = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return chosen.select(*docs.columns).unionByName(docs.filter(~has_words))


def near_dup_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    rows, found = near_duplicates(docs, Scratch(spark), shingle_words=3, min_percent=85)
    placed = rows.join(found, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return placed.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


# All pairs that share a shingle, counted; components by following the links.
NEAR_DUP_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, w[i:i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 0) + 2)) AS i FROM d WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, m.n, n.n
  HAVING 100 * count(*) >= 85 * (m.n + n.n - count(*))
), reach AS (
  SELECT doc_id AS u, doc_id AS v FROM d
  UNION
  SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
), roots AS (
  SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM roots LEFT JOIN sizes USING (doc_id)
"""
