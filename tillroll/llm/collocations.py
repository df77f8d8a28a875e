"""Collocations from count streams in prefix and suffix order.

Words get numbers in their order, language by language, and phrases of two and three words are
counted by numbers. The counts of words, pairs and triples are then put into one stream, in the
order of their words from the front (prefix order) and in another from the back (suffix order). In
prefix order, a phrase's first word comes before it, and so does its first pair; right after a pair
come the triples it begins. So one pass in lockstep over the sorted stream, which remembers the
last word and the last pair, gives each phrase the counts of its beginnings and each pair that of its most frequent
extension to the right; the same pass over the other stream gives ends and extensions to the left.
No table of phrases is built or looked up.

A stream is cut into ranges of the order, however many triples one word begins: what a range has to
know of the one before is its last word and pair, one row for each range.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import assign_dense_key, top_n_per_group
from tillroll.scratch import Scratch

MIN_COUNT = 10
ABSORB_PERCENT = 50
TOP = 2_000
SCALE = 1_000_000
NO_LANGUAGE = "und"

# A block holds the words of one language from one task's texts, at most so many and so many
# different ones; a task holds at most twice as many words before it closes its largest block.
BLOCK_WORDS, BLOCK_VOCABULARY = 1 << 21, 1 << 20
PIECE_BYTES = 1 << 20
WORDS_A_ROW = 4096
ROWS_A_BATCH = 1 << 18

_BREAK = b"\xff"  # no byte of a text
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0xFF if b in b".,;:!?\x0a\x0b\x0c\x0d" else b for b in range(256)
)
_ENDS = frozenset(b" \t.,;:!?\x0a\x0b\x0c\x0d")

BLOCK = "block binary, lang string, first int, words array<string>, counts array<int>, ids binary, context int"
GRAM = "w1 long, w2 long, w3 long, c long"
STREAM = "kind int, k1 long, k2 long, k3 long, f long, one long, two long, longest long"
PHRASE, HEAD, REST = 0, 1, 2


# -- blocks ----------------------------------------------------------------------------------


def _words(text: bytes) -> Iterator[list[bytes]]:
    """Lowered words with breaks between pieces, from stretches of bounded size."""
    start = 0
    while start < len(text):
        end = start + PIECE_BYTES
        while end < len(text) and text[end] not in _ENDS:
            end += 1
        yield text[start:end].translate(_TABLE).replace(_BREAK, b" " + _BREAK + b" ").split()
        start = end


class _Block:
    """Words of one language, as numbers in the order of their first occurrence; 0 is a break."""

    def __init__(self, lang: str, before: tuple[bytes, ...] = ()):
        self.lang = lang
        self.numbers: dict[bytes, int] = defaultdict(count().__next__)
        self.numbers[_BREAK]
        self.parts: list[np.ndarray] = []
        self.size = 0
        self.context = len(before)
        self.add(list(before))

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def full(self) -> bool:
        return self.size >= BLOCK_WORDS or len(self.numbers) >= BLOCK_VOCABULARY

    def close(self) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate(self.parts) if self.parts else np.zeros(0, np.int32)
        counts = np.bincount(ids[self.context :], minlength=len(self.numbers))
        words = [w.decode() for w in list(self.numbers)[1:]]
        name = uuid.uuid4().bytes
        packed = zstandard.compress(ids.astype("<i4").tobytes(), 1)
        for first in range(0, max(len(words), 1), WORDS_A_ROW):
            part = words[first : first + WORDS_A_ROW]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name], pa.binary()),
                    pa.array([self.lang]),
                    pa.array([first + 1], pa.int32()),
                    pa.array([part], pa.list_(pa.string())),
                    pa.array([counts[first + 1 : first + 1 + len(part)].astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([packed if first == 0 else None], pa.binary()),
                    pa.array([self.context], pa.int32()),
                ],
                names=["block", "lang", "first", "words", "counts", "ids", "context"],
            )


def _blocks(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """The texts as blocks. A block closed inside a text goes on in the next one from its last
    two words, its context, which is not counted again."""

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks: dict[str, _Block] = {}
        held = 0
        for frame in frames:
            for own, body in zip(frame.column(0), frame.column(1), strict=True):
                if not body.is_valid:
                    continue
                own = own.as_py()
                block = open_blocks.setdefault(own, _Block(own))
                tail: list[bytes] = []
                for words in _words(body.as_py()):
                    block.add(words)
                    tail = (tail + words[-2:])[-2:]
                    held += len(words)
                    if block.full():
                        yield from block.close()
                        held -= block.size
                        block = open_blocks[own] = _Block(own, tuple(tail))
                        held += block.size
                block.add([_BREAK])
                held += 1
                while held > 2 * BLOCK_WORDS:
                    most = max(open_blocks.values(), key=lambda b: b.size)
                    yield from most.close()
                    held -= most.size
                    del open_blocks[most.lang]
        for block in open_blocks.values():
            yield from block.close()

    slim = docs.select(F.coalesce(F.col(lang), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text).cast("binary").alias("text"))
    return slim.mapInArrow(batches, BLOCK)


def _grams(blocks: DataFrame, numbered: DataFrame) -> DataFrame:
    """Pairs (``w3`` 0) and triples of numbered words of each block, each once with its count."""

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for ids, context, at, number in zip(*(frame.column(k) for k in range(4)), strict=True):
                words, context = np.frombuffer(zstandard.decompress(ids.as_py()), "<i4"), context.as_py()
                places, numbers = at.values.to_numpy(), number.values.to_numpy()
                if not len(places):
                    continue
                # Local numbers from 1 on, in the order of the words; 0 for breaks and rare ones.
                order = np.argsort(numbers)
                numbers = np.concatenate(([0], numbers[order]))
                local = np.zeros(max(words.max(initial=0), places.max()) + 1, np.int64)
                local[places[order]] = np.arange(1, len(numbers))
                own = local[words]
                bits = np.int64(len(numbers)).item().bit_length()
                for size in (2, 3):
                    first = max(0, context - size + 1)
                    parts = [own[first + k : len(own) - size + 1 + k] for k in range(size)]
                    keys = np.zeros(max(0, len(own) - size + 1 - first), np.int64)
                    whole = np.ones(len(keys), bool)
                    for part in parts[: 3 if len(keys) else 0]:
                        keys = keys << bits | part
                        whole &= part > 0
                    keys, counts = np.unique(keys[whole], return_counts=True)
                    mask = (1 << bits) - 1
                    for start in range(0, len(keys), ROWS_A_BATCH):
                        part = keys[start : start + ROWS_A_BATCH]
                        columns = [numbers[part >> bits * (size - 1 - k) & mask] for k in range(size)]
                        columns += [np.zeros(len(part), np.int64)] * (3 - size)
                        columns.append(counts[start : start + ROWS_A_BATCH].astype(np.int64))
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["w1", "w2", "w3", "c"])

    bodies = blocks.filter("ids IS NOT NULL").select("block", "ids", "context")
    return bodies.join(numbered, "block").select("ids", "context", "at", "number").mapInArrow(batches, GRAM)


# -- streams ---------------------------------------------------------------------------------


def _lockstep(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over a range of a stream (k1, k2, k3, f) in its order, missing words being 0.

    Yields every pair and triple with ``one`` = f(k1) and, of triples, ``two`` = f(k1 k2), if they
    are in this range; pairs also with ``longest``, the largest count of a triple after them. Then what
    the next ranges need: the last word and the last pair with their counts (``HEAD``). Triples at
    the start that belong to a pair of a range before leave their largest count (``REST``).
    """
    word = (-1, 0)  # the last word and its count
    pair: tuple[int, int, int, int] | None = None  # the last pair, its count and f(k1)
    longest = 0
    rest: tuple[int, int, int] | None = None

    def rows(kind: int, *columns) -> pa.RecordBatch:
        size = len(columns[0])
        arrays = [pa.array(np.full(size, kind, np.int32))]
        for c in columns:
            if isinstance(c, tuple):
                values, known = c
                arrays.append(pa.array(values, pa.int64(), mask=~known))
            else:
                arrays.append(pa.array(np.asarray(c, np.int64)))
        return pa.RecordBatch.from_arrays(arrays, names=["kind", "k1", "k2", "k3", "f", "one", "two", "longest"])

    none = (np.zeros(1, np.int64), np.zeros(1, bool))
    maybe = lambda x: none if x is None else [x]
    for frame in frames:
        k1, k2, k3, f = (frame.column(k).to_numpy() for k in range(4))
        if not len(k1):
            continue
        is_word, is_triple = k2 == 0, k3 > 0
        is_pair = ~is_word & ~is_triple
        # The last word and the last pair at or before each row; -1: before this frame.
        at = np.arange(len(k1))
        last_word = np.maximum.accumulate(np.where(is_word, at, -1))
        last_pair = np.maximum.accumulate(np.where(is_pair, at, -1))
        one = np.where(last_word >= 0, f[last_word], word[1])
        one_known = np.where(last_word >= 0, k1[last_word], word[0]) == k1
        earlier = pair if pair is not None else (-1, -1, 0, 0)
        pair_1 = np.where(last_pair >= 0, k1[last_pair], earlier[0])
        pair_2 = np.where(last_pair >= 0, k2[last_pair], earlier[1])
        two = np.where(last_pair >= 0, f[last_pair], earlier[2])
        two_known = (pair_1 == k1) & (pair_2 == k2)
        if is_triple.any():
            t = is_triple
            yield rows(PHRASE, k1[t], k2[t], k3[t], f[t], (one[t], one_known[t]), (two[t], two_known[t]), np.zeros(t.sum()))
        # Triples whose pair is in an earlier range stand at the start of this one.
        orphans = is_triple & ~two_known
        if orphans.any():
            most = int(f[orphans].max())
            o = int(np.flatnonzero(orphans)[0])
            rest = (int(k1[o]), int(k2[o]), max(most, rest[2] if rest else 0))
        places = np.flatnonzero(is_pair)
        triples = np.where(is_triple & two_known, f, 0)
        until = places[0] if len(places) else len(k1)
        longest = max(longest, int(triples[:until].max(initial=0)))
        if len(places):
            if pair is not None:
                yield rows(PHRASE, [pair[0]], [pair[1]], [0], [pair[2]], maybe(pair[3]), none, [longest])
            most = np.maximum.reduceat(triples, places)
            done = places[:-1]
            if len(done):
                yield rows(PHRASE, k1[done], k2[done], k3[done], f[done], (one[done], one_known[done]), (f[done], np.zeros(len(done), bool)), most[:-1])
            p = places[-1]
            pair = (int(k1[p]), int(k2[p]), int(f[p]), int(one[p]) if one_known[p] else None)
            longest = int(most[-1])
        if is_word.any():
            w = int(np.flatnonzero(is_word)[-1])
            word = (int(k1[w]), int(f[w]))
    if pair is not None:
        yield rows(PHRASE, [pair[0]], [pair[1]], [0], [pair[2]], maybe(pair[3]), none, [longest])
        yield rows(HEAD, [pair[0]], [pair[1]], [0], [pair[2]], none, none, [0])
    if word[0] >= 0:
        yield rows(HEAD, [word[0]], [0], [0], [word[1]], none, none, [0])
    if rest is not None:
        yield rows(REST, [rest[0]], [rest[1]], [0], [0], none, none, [rest[2]])


def _passed(stream: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(k1, k2, k3, f, one, two, longest) of all pairs and triples of a stream."""
    order = ["k1", "k2", "k3"]
    placed = stream.repartitionByRange(*order).sortWithinPartitions(*order)
    found = scratch.cut(placed.mapInArrow(_lockstep, STREAM), name)
    # One word, one pair and one rest from each range.
    heads = found.filter(F.col("kind") == HEAD)
    words = heads.filter("k2 = 0").select(F.col("k1").alias("h1"), F.col("f").alias("word_f"))
    pairs = heads.filter("k2 > 0").select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("f").alias("pair_f"))
    rests = found.filter(F.col("kind") == REST).groupBy(F.col("k1").alias("r1"), F.col("k2").alias("r2"))
    rests = rests.agg(F.max("longest").alias("rest"))
    phrases = found.filter(F.col("kind") == PHRASE).drop("kind")
    known = (
        phrases.join(F.broadcast(words), F.col("k1") == F.col("h1"), "left")
        .join(F.broadcast(pairs), (F.col("k1") == F.col("p1")) & (F.col("k2") == F.col("p2")) & (F.col("k3") > 0), "left")
        .join(F.broadcast(rests), (F.col("k1") == F.col("r1")) & (F.col("k2") == F.col("r2")) & (F.col("k3") == 0), "left")
    )
    return known.select(
        "k1", "k2", "k3", "f",
        F.coalesce("one", "word_f").alias("one"),
        F.coalesce("two", "pair_f").alias("two"),
        F.greatest("longest", F.coalesce("rest", F.lit(0))).alias("longest"),
    )


def _score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)), exactly, for counts below 10^15."""
    whole = lambda c: f"CAST({c} AS decimal(15,0))"
    return F.expr(f"(CAST({SCALE} AS decimal(7,0)) * {whole(a)} * {whole(a)}) div ({whole(left)} * {whole(right)})")


def _rated(prefix: DataFrame, suffix: DataFrame, absorb_percent: int) -> DataFrame:
    """(w1, w2, w3, a, l, r, score) of the phrases that no longer one absorbs."""
    front = prefix.select(
        F.col("k1").alias("w1"), F.col("k2").alias("w2"), F.col("k3").alias("w3"), F.col("f").alias("a"),
        F.col("one").alias("begin_1"), F.col("two").alias("begin_2"), F.col("longest").alias("to_right"),
    )
    # In suffix order, words stand from the last to the first.
    pair = F.col("k3") == 0
    back = suffix.select(
        F.when(pair, F.col("k2")).otherwise(F.col("k3")).alias("w1"),
        F.when(pair, F.col("k1")).otherwise(F.col("k2")).alias("w2"),
        F.when(pair, F.lit(0)).otherwise(F.col("k1")).alias("w3"),
        F.col("one").alias("end_1"), F.col("two").alias("end_2"), F.col("longest").alias("to_left"),
    )
    both = front.join(back, ["w1", "w2", "w3"])
    absorbed = (F.col("w3") == 0) & (100 * F.greatest("to_left", "to_right") >= absorb_percent * F.col("a"))
    cuts = both.filter(~absorbed).select(
        "w1", "w2", "w3", "a",
        F.col("begin_1").alias("l_1"),
        F.when(F.col("w3") == 0, F.col("end_1")).otherwise(F.col("end_2")).alias("r_1"),
        F.when(F.col("w3") > 0, F.col("begin_2")).alias("l_2"),
        F.when(F.col("w3") > 0, F.col("end_1")).alias("r_2"),
    )
    scored = cuts.withColumn("s_1", _score("a", "l_1", "r_1")).withColumn("s_2", _score("a", "l_2", "r_2"))
    second = F.coalesce(F.col("s_2") < F.col("s_1"), F.lit(False))
    return scored.select(
        "w1", "w2", "w3", "a",
        F.when(second, F.col("l_2")).otherwise(F.col("l_1")).alias("l"),
        F.when(second, F.col("r_2")).otherwise(F.col("r_1")).alias("r"),
        F.when(second, F.col("s_2")).otherwise(F.col("s_1")).alias("score"),
    )


def collocations(
    docs: DataFrame,
    scratch: Scratch,
    lang: str = "lang",
    text: str = "text",
    min_count: int = MIN_COUNT,
    absorb_percent: int = ABSORB_PERCENT,
    top: int = TOP,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lowered (A-Z), split into pieces at punctuation and line ends, and these into words
    at spaces and tabs. A phrase of two or three words within a piece is a candidate from
    ``min_count`` occurrences (``a``) on. Its score is that of its lowest-scoring cut, the first
    on a tie; ``l`` and ``r`` count the parts, ``n`` all words of the language. A pair goes if a
    triple that holds it has ``absorb_percent`` of its count or more, whether this one stays or not.

    Null languages are ``und``, null texts empty; repeated rows count, other columns are not
    read, and an empty table has no phrases. Long texts are read in stretches. Words below
    ``min_count`` are in no candidate and get no number; everything else is counted.
    """
    if min_count < 1 or top < 1:
        raise ValueError("min_count and top must be positive")
    blocks = scratch.cut(_blocks(docs, lang, text), "blocks")
    words = blocks.select("block", "lang", "first", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "x"))
    words = words.select("block", "lang", (F.col("first") + F.col("at")).alias("at"), F.col("x.words").alias("word"), F.col("x.counts").alias("c"))
    counted = scratch.cut(words.groupBy("lang", "word").agg(F.sum("c").cast("long").alias("f")), "words")
    totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = counted.filter(F.col("f") >= min_count)
    vocabulary = scratch.cut(assign_dense_key(frequent, [F.asc("lang"), F.asc("word")], "number", scratch), "vocabulary")
    # The numbers of each block's words; as many as the block has different words, at most.
    numbered = words.join(vocabulary.select("lang", "word", "number"), ["lang", "word"]).groupBy("block")
    numbered = numbered.agg(F.collect_list(F.struct("at", "number")).alias("x"))
    numbered = numbered.select("block", F.col("x.at").alias("at"), F.col("x.number").alias("number"))

    grams = _grams(blocks, numbered)
    # Each block has counted its own: what is dealt here is at most one row for each and a phrase.
    summed = grams.repartition("w1", "w2", "w3").groupBy("w1", "w2", "w3").agg(F.sum("c").alias("f"))
    phrases = scratch.cut(summed.filter(F.col("f") >= min_count), "phrases")

    none = F.lit(0).cast("long")
    singles = vocabulary.select(F.col("number").alias("k1"), none.alias("k2"), none.alias("k3"), "f")
    pair = F.col("w3") == 0
    forward = phrases.select(F.col("w1").alias("k1"), F.col("w2").alias("k2"), F.col("w3").alias("k3"), "f")
    backward = phrases.select(
        F.when(pair, F.col("w2")).otherwise(F.col("w3")).alias("k1"),
        F.when(pair, F.col("w1")).otherwise(F.col("w2")).alias("k2"),
        F.when(pair, none).otherwise(F.col("w1")).alias("k3"),
        "f",
    )
    prefix = _passed(singles.unionByName(forward), scratch, "prefix")
    suffix = _passed(singles.unionByName(backward), scratch, "suffix")
    rated = scratch.cut(_rated(prefix, suffix, absorb_percent), "rated")

    spelled = rated
    for k in (1, 2, 3):
        own = vocabulary.select(F.col("number").alias(f"w{k}"), F.col("word").alias(f"t{k}"), *(["lang"] if k == 1 else []))
        spelled = spelled.join(own, f"w{k}", "inner" if k < 3 else "left")
    # A phrase of two words has no third, and concat_ws leaves it out.
    spelled = spelled.select("lang", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), "a", "l", "r", "score")
    ranked = top_n_per_group(spelled, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top, "rank")
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )


def collocation_query(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2,000 phrases of each language of the whole table."""
    return collocations(spark.read.parquet(f"{folder}/documents.parquet"), Scratch(spark))


COLLOCATION_SQL = r"""
WITH words AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
        FROM documents)
), f AS MATERIALIZED (
  SELECT lang, p, k, count(*) AS c
  FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
              FROM words CROSS JOIN (VALUES (1), (2), (3)) sizes(k) WHERE len(w) >= k))
  GROUP BY lang, p, k
), totals AS (
  SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS MATERIALIZED (
  SELECT lang, p, k, c, string_split(p, ' ') AS g FROM f WHERE k >= 2 AND c >= 10
), parts AS MATERIALIZED (
  SELECT lang, p, c AS a, cut, array_to_string(g[1:cut], ' ') AS first, array_to_string(g[cut + 1:k], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)
), cuts AS (
  SELECT x.lang, x.p, x.a, x.cut, l.c AS l, r.c AS r,
         CAST(CAST(1000000 AS HUGEINT) * x.a * x.a // (CAST(l.c AS HUGEINT) * r.c) AS BIGINT) AS score
  FROM parts x
  JOIN f l ON l.lang = x.lang AND l.p = x.first
  JOIN f r ON r.lang = x.lang AND r.p = x.rest
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1
), absorbed AS (
  SELECT DISTINCT s.lang, s.p FROM candidates s
  JOIN (SELECT lang, c, unnest([array_to_string(g[1:2], ' '), array_to_string(g[2:3], ' ')]) AS part
        FROM candidates WHERE k = 3) b
    ON b.lang = s.lang AND b.part = s.p AND 100 * b.c >= 50 * s.c
), ranked AS (
  SELECT lang, p AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank
  FROM best ANTI JOIN absorbed USING (lang, p)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
