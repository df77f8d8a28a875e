"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton reads a document word by word and knows at every word the longest item passage
that ends there. Passages of a whole window, or whole short items, mark their words. Words that
follow each other in no item can not be inside a passage; they are skipped with one vector
look-up, and only the stretches between them are read by the automaton.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import lots, release_memory
from tillroll.scratch import Scratch

WINDOW = 10
# Words of the benchmark in one automaton; a larger benchmark is read in several passes.
BLOCK_WORDS = 50_000
# Texts whose word numbers are held at once.
LOT_BYTES = 1 << 21
# A document with this share of words in item passages goes as a whole.
MAX_COVERAGE = 0.5

_TABLE_BITS = 22
# Digits, letters and all bytes of non-ASCII characters make words; ASCII capitals are lowered.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(SPAN)),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("n_items", T.LongType()),
    ]
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class ItemAutomaton:
    """Suffix automaton of some items, over word numbers."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.names = [name for name, words in items if words]
        texts = [words for _, words in items if words]
        self.numbers: dict[bytes, int] = {}
        for words in texts:
            for word in words:
                self.numbers.setdefault(word, len(self.numbers))
        coded = [[self.numbers[w] for w in words] for words in texts]
        self.shortest = min((min(len(c), window) for c in coded), default=window)
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for codes in coded:
            state = 0
            for code in codes:
                state = self._extend(state, code)
        self._register(coded)
        self.pairs = np.zeros(1 << _TABLE_BITS, bool)
        for codes in coded:
            own = np.asarray(codes, np.int64)
            self.pairs[self._pair(own[:-1], own[1:])] = True

    def _new(self, length: int) -> int:
        self.next.append({})
        self.link.append(-1)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, parent: int, code: int, child: int) -> int:
        """The state of exactly the passages one word longer than those of ``parent``."""
        if self.length[child] == self.length[parent] + 1:
            return child
        copy = self._new(self.length[parent] + 1)
        self.next[copy] = dict(self.next[child])
        self.link[copy] = self.link[child]
        self.link[child] = copy
        while parent != -1 and self.next[parent].get(code) == child:
            self.next[parent][code] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, code: int) -> int:
        known = self.next[last].get(code)
        if known is not None:
            return self._split(last, code, known)
        state = self._new(self.length[last] + 1)
        parent = last
        while parent != -1 and code not in self.next[parent]:
            self.next[parent][code] = state
            parent = self.link[parent]
        self.link[state] = 0 if parent == -1 else self._split(parent, code, self.next[parent][code])
        return state

    def _register(self, coded: list[list[int]]) -> None:
        """Which items a full window belongs to, and which short items end in a state."""
        self.windows: dict[int, set[int]] = {}
        ends: dict[int, list[tuple[int, int]]] = {}
        for item, codes in enumerate(coded):
            state, length = 0, 0
            for code in codes:
                state, length = self._step(state, length, code)
                if length == self.window:
                    self.windows.setdefault(state, set()).add(item)
            if len(codes) < self.window:
                ends.setdefault(state, []).append((len(codes), item))
        self.short: dict[int, list[tuple[int, int]]] = {}
        if ends:
            for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
                found = ends.get(state, []) + self.short.get(self.link[state], [])
                if found:
                    self.short[state] = found

    def _step(self, state: int, length: int, code: int) -> tuple[int, int]:
        """Read a word; the longest match is followed up to the window."""
        while state and code not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        if code not in self.next[state]:
            return 0, 0
        state, length = self.next[state][code], length + 1
        if length > self.window:
            length = self.window
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state, length

    @staticmethod
    def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        mixed = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - _TABLE_BITS)

    def stretches(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches of words of which every neighbouring pair may be in an item; code -1 is no
        item word."""
        if not len(codes):
            return
        known = codes >= 0
        joined = known[:-1] & known[1:]
        joined[joined] = self.pairs[self._pair(codes[:-1][joined], codes[1:][joined])]
        opens = known & np.concatenate(([True], ~joined))
        closes = known & np.concatenate((~joined, [True]))
        starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        long = ends - starts >= self.shortest
        yield from zip(starts[long].tolist(), ends[long].tolist(), strict=True)

    def passages(self, codes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(start, end, item) of every window and short item found."""
        for start, end in self.stretches(codes):
            state, length = 0, 0
            for at, code in enumerate(codes[start:end].tolist(), start + 1):
                state, length = self._step(state, length, code)
                if length == self.window:
                    for item in self.windows[state]:
                        yield at - length, at, item
                for size, item in self.short.get(state, ()):
                    if size <= length:
                        yield at - size, at, item


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _judge(texts: list[bytes], automaton: ItemAutomaton) -> list[tuple]:
    """n_words, spans, item names and number of items of every text."""
    number = automaton.numbers.get
    counts, codes = [], []
    for text in texts:
        words = words_of(text)
        counts.append(len(words))
        codes.append(np.fromiter((number(w, -1) for w in words), np.int64, len(words)))
        codes.append(np.full(1, -1))  # no passage crosses documents
    stream = np.concatenate(codes) if codes else np.zeros(0, np.int64)
    begins = np.concatenate(([0], np.cumsum(np.asarray(counts, np.int64) + 1)))
    spans: list[list] = [[] for _ in texts]
    items: list[set] = [set() for _ in texts]
    for start, end, item in automaton.passages(stream):
        doc = int(np.searchsorted(begins, start, "right")) - 1
        spans[doc].append((start - int(begins[doc]), end - int(begins[doc])))
        items[doc].add(item)
    return [
        (n, _merged(s), sorted(automaton.names[i] or "" for i in found), len(found))
        for n, s, found in zip(counts, spans, items, strict=True)
    ]


def _automata(benchmark: DataFrame, window: int, block_words: int) -> Iterator[ItemAutomaton]:
    """One automaton for every ``block_words`` words of items; an item is never divided."""
    block: list[tuple[str | None, list[bytes]]] = []
    size = 0
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    for row in items.toLocalIterator():
        words = words_of(bytes(row["text"] or b""))
        block.append((row["item"], words))
        size += len(words)
        if size >= block_words:
            yield ItemAutomaton(block, window)
            block, size = [], 0
    if block:
        yield ItemAutomaton(block, window)


def _scanner(spark: SparkSession, automaton: ItemAutomaton):
    shared = spark.sparkContext.broadcast(automaton)  # bounded by block_words

    @F.pandas_udf(FOUND)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t or b"" for t in batch]
            found = [x for first, last in lots(texts, LOT_BYTES) for x in _judge(texts[first:last], shared.value)]
            rows = [
                (n, [{"start": a, "end": b} for a, b in spans], names, items) for n, spans, names, items in found
            ]
            yield pd.DataFrame(rows, columns=[f.name for f in FOUND.fields])
        release_memory()

    return scan.asNondeterministic()


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    scratch: Scratch | None = None,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items (ids as strings, sorted), hit_spans (of word
    positions) and contaminated, replacing columns of these names.

    Words are runs of digits, letters and non-ASCII characters, ASCII letters lowered. A window
    is ``window`` consecutive item words; an item with fewer words is one window; an item without
    words is none. A document word inside any occurrence of a window is hit. Null texts have no
    words. Every benchmark row is an item of its own; a missing id is listed as the empty text.
    An empty benchmark hits nothing. Documents are read whole and judged one by one.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    taken = ["n_words", "n_hit", "n_items", "items", "hit_spans", "contaminated"]
    scanned = docs.drop(*taken)
    passes: list[str] = []
    for automaton in _automata(benchmark, window, block_words):
        if passes:
            scanned = scratch.cut(scanned, "pass")
        passes.append(f"_pass{len(passes)}")
        scanned = scanned.withColumn(passes[-1], _scanner(spark, automaton)(F.col("text").cast("binary")))
    if not passes:
        empty = ItemAutomaton([], window)
        passes.append("_pass0")
        scanned = scanned.withColumn("_pass0", _scanner(spark, empty)(F.col("text").cast("binary")))
    spans = F.flatten(F.array(*(F.col(f"{p}.spans") for p in passes)))
    hit = F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["end"] - 1))))
    items = F.array_sort(F.flatten(F.array(*(F.col(f"{p}.items") for p in passes))))
    found = scanned.select(
        *(c for c in scanned.columns if c not in passes),
        F.col(f"{passes[0]}.n_words").alias("n_words"),
        F.size(hit).cast("long").alias("n_hit"),
        sum((F.col(f"{p}.n_items") for p in passes), F.lit(0)).cast("long").alias("n_items"),
        items.alias("items"),
        spans.alias("hit_spans"),
    )
    return found.withColumn("contaminated", F.col("n_hit") > 0)


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the bytes from the first to the last word of each span."""
    places = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for start, end in _merged(spans):
        out.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return b"".join([*out, text[at:]])


@F.pandas_udf(T.StringType())
def remove_spans(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts without their hit words and what stands between these."""
    return pd.Series(
        [
            None if t is None else _without(t, [(s["start"], s["end"]) for s in found]).decode("utf-8", "replace")
            for t, found in zip(texts, spans, strict=True)
        ],
        dtype=object,
    )


def cleaned(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """``docs`` without item passages: hit words go, and with them documents of which they are
    ``max_coverage`` or more. Texts whose remains meet in a new passage are cleaned again."""
    others = [c for c in docs.columns if c != "text"]

    def judged(rows: DataFrame) -> DataFrame:
        packed = rows.select(F.struct(*others).alias("_row"), "text")
        return find_contamination(packed, benchmark, scratch).select("_row", "text", "n_words", "n_hit", "hit_spans")

    def rows_of(found: DataFrame) -> DataFrame:
        return found.select(*(F.col(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns))

    rest = remove_spans(F.col("text").cast("binary"), "hit_spans")
    hit = F.col("n_hit") > 0
    first = judged(docs).filter(~hit | (F.col("n_hit") < max_coverage * F.col("n_words")))
    text = F.when(hit, rest).otherwise(F.col("text"))
    state = scratch.cut(first.select("_row", text.alias("text"), hit.alias("_again")), "cleaned")
    done = rows_of(state.filter("not _again"))
    again = rows_of(state.filter("_again"))
    while True:
        found = scratch.cut(judged(again), "again")
        done = done.unionByName(rows_of(found.filter(~hit)))
        if found.filter(hit).isEmpty():
            return done
        again = scratch.cut(rows_of(found.filter(hit).withColumn("text", rest)), "rest")


def decontamination_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = find_contamination(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


# Windows as lists of words, matched as they are; words covered by any match are counted once.
DECONTAMINATION_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, w[i:i + least(len(w), 10) - 1] AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)
), places AS (
  SELECT doc_id, i, s.n, w[i:i + s.n - 1] AS g
  FROM (SELECT DISTINCT n FROM windows) s,
       LATERAL (SELECT doc_id, w, unnest(range(1, len(w) - s.n + 2)) AS i FROM d WHERE len(w) >= s.n)
), hits AS (
  SELECT doc_id, i, p.n, item_id FROM places p JOIN windows v ON p.n = v.n AND p.g = v.g
), words AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
