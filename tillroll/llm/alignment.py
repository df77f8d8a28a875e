"""Alignment of two tokenizers by interval coalescing.

Tokenizer A is a byte-level BPE (a ``tokenizers`` file), B a piece BPE with byte fallback (a
``sentencepiece`` model). Both cut the same bytes, a space and the text, into intervals. All
intervals are sorted by start and their ends accumulated to a running maximum; a group ends where
the next start reaches it. A token pair whose intervals end together is a link, and the links of
all documents are counted by their pair of ids.

Two ids can be linked only if the bytes of one are a suffix of the other's, so there are at most
as many pairs as the entries of both vocabularies have bytes, however large the corpus: pairs are
numbered from the vocabularies, and their counts fit into one small array.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.scratch import Scratch

FOLDER = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Texts are encoded in chunks of about so many characters, cut where neither tokenizer joins.
CHUNK_CHARS = 1 << 14
# Tokens that one batch of rows holds, but for a single longer text.
BATCH_TOKENS = 1 << 19
SPACE_MARK = "▁"

# Fixed value: how byte-level tokenizers of this kind cut a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# One space between two characters that are no blanks: words on both sides are encoded apart.
_CUT = re.compile(rf"(?<=[^\s{SPACE_MARK}]) (?=\S)")

ALIGNED = "id long, a array<int>, b array<int>, a_sizes array<int>, b_sizes array<int>"
DIGESTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links array<int>"


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in entries of byte-level vocabularies: printable
    ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + n): b for n, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers from the contents of their files, and the bytes of every entry."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import sentencepiece
        import tiktoken

        spec = json.loads(a_file)
        vocabulary, letters = spec["model"]["vocab"], _byte_letters()
        special = {t["content"] for t in spec["added_tokens"]}
        entries = {
            number: bytes(letters[c] for c in entry) for entry, number in vocabulary.items() if entry not in special
        }
        self.a_bytes = [entries.get(n, b"") for n in range(max(vocabulary.values()) + 1)]
        # Ranks give the same tokens sooner if merges are numbered in their order.
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        numbers = [vocabulary[x + y] for x, y in merges]
        pre = spec["pre_tokenizer"]
        plain = spec["normalizer"] is None and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
        ranked = plain and all(x < y for x, y in zip(numbers, numbers[1:], strict=False))
        self._ranks = (
            tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks={b: n for n, b in entries.items()}, special_tokens={})
            if ranked and len(set(entries.values())) == len(entries) and all(bytes([n]) in entries.values() for n in range(256))
            else None
        )
        self._file, self._slow = a_file.decode(), None
        self._b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        pieces = [self._b.id_to_piece(n) for n in range(self._b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self._b.is_byte(n) else p.replace(SPACE_MARK, " ").encode()
            for n, p in enumerate(pieces)
        ]
        for n in range(len(pieces)):
            if self._b.is_control(n) or self._b.is_unknown(n):
                self.b_bytes[n] = b""
        self._cuts = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)
        self.a_lengths = np.array([len(x) for x in self.a_bytes])
        self.b_lengths = np.array([len(x) for x in self.b_bytes])

    def _merged(self, text: str) -> list[int]:
        """A's ids of a text by its merges, one after the other; only loaded where ranks won't do."""
        from tokenizers import Tokenizer

        if self._slow is None:
            self._slow = Tokenizer.from_str(self._file)
            self._slow.encode_special_tokens = True
        return self._slow.encode(text, add_special_tokens=False).ids

    def _chunks(self, text: str) -> Iterator[str]:
        start = 0
        while self._cuts and len(text) - start > CHUNK_CHARS:
            cut = _CUT.search(text, start + CHUNK_CHARS)
            if cut is None:
                break
            yield text[start : cut.start()]
            start = cut.start() + 1
        yield text[start:]

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of A for a space and the text, and of B, which adds the space; none if the bytes
        of either differ from these."""
        if not text:
            return [], []
        a: list[int] = []
        b: list[int] = []
        for chunk in self._chunks(text):
            # Ranks take the square of a run of letters: long runs go the other way.
            if self._ranks is not None and len(chunk) <= 2 * CHUNK_CHARS:
                a += self._ranks.encode_ordinary(" " + chunk)
            else:
                a += self._merged(" " + chunk)
            b += self._b.encode(chunk)
        whole = b" " + text.encode()
        # Ranks that hold every byte give back what they are given.
        for ids, entries, sure in ((a, self.a_bytes, self._ranks is not None), (b, self.b_bytes, False)):
            if not sure and b"".join(map(entries.__getitem__, ids)) != whole:
                return [], []
        return a, b

    @property
    def pairs(self) -> np.ndarray:
        """All pairs of ids of which one's bytes are a suffix of the other's, as
        ``a * number of B's entries + b``, ascending."""
        by_a: dict[bytes, list[int]] = {}
        by_b: dict[bytes, list[int]] = {}
        for found, entries in ((by_a, self.a_bytes), (by_b, self.b_bytes)):
            for n, entry in enumerate(entries):
                if entry:
                    found.setdefault(entry, []).append(n)
        size = len(self.b_bytes)
        codes = [
            n * size + m for entry, own in by_a.items() for k in range(len(entry)) for m in by_b.get(entry[k:], ()) for n in own
        ]
        codes += [
            n * size + m for entry, own in by_b.items() for k in range(1, len(entry)) for n in by_a.get(entry[k:], ()) for m in own
        ]
        return np.unique(np.array(codes, np.int64))


@lru_cache(maxsize=2)
def _loaded(a_file: bytes, b_file: bytes) -> tuple[Tokenizers, np.ndarray]:
    both = Tokenizers(a_file, b_file)
    return both, both.pairs


def coalesce(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers of the tokens of A and of B, from their lengths in bytes.

    Both cut the same bytes. Tokens are sorted by start; a group breaks where a start reaches the
    running maximum of the ends before it.
    """
    ends = np.concatenate((np.cumsum(a_lengths), np.cumsum(b_lengths)))
    starts = ends - np.concatenate((a_lengths, b_lengths))
    side = np.repeat(np.array([0, 1], np.int8), (len(a_lengths), len(b_lengths)))
    order = np.lexsort((side, starts))
    reached = np.maximum.accumulate(ends[order])
    breaks = np.concatenate(([False], starts[order][1:] >= reached[:-1]))[: len(order)]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks)
    return group[: len(a_lengths)], group[len(a_lengths) :]


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.int32)))


def _aligned_batch(both: Tokenizers, ids: list, tokens: list[tuple[list[int], list[int]]]) -> pa.RecordBatch:
    n_a = np.array([len(a) for a, _ in tokens], np.int64)
    n_b = np.array([len(b) for _, b in tokens], np.int64)
    a = np.concatenate([np.array(t[0], np.int64) for t in tokens])
    b = np.concatenate([np.array(t[1], np.int64) for t in tokens])
    # Texts one after the other: each ends in a group of its own.
    of_a, of_b = coalesce(both.a_lengths[a], both.b_lengths[b])
    groups = int(of_a[-1]) + 1 if len(of_a) else 0
    ends = np.cumsum(n_a)
    until = np.where(ends > 0, np.append(of_a + 1, 0)[ends - 1], 0)
    n_groups = np.diff(np.concatenate(([0], until)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            _lists(a, n_a),
            _lists(b, n_b),
            _lists(np.bincount(of_a, minlength=groups), n_groups),
            _lists(np.bincount(of_b, minlength=groups), n_groups),
        ],
        names=["id", "a", "b", "a_sizes", "b_sizes"],
    )


def read_tokenizers(spark: SparkSession, folder: str = FOLDER, a_file: str = A_FILE, b_file: str = B_FILE):
    """The contents of both files, broadcast: only the driver has to see the folder, and their
    size does not depend on the data."""
    return spark.sparkContext.broadcast((Path(folder, a_file).read_bytes(), Path(folder, b_file).read_bytes()))


def _align(files) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of (id, text) to batches of ``ALIGNED``."""

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, _ = _loaded(*files.value)
        ids: list = []
        tokens: list[tuple[list[int], list[int]]] = []
        size = 0
        for frame in frames:
            for name, value in zip(frame.column(0), frame.column(1), strict=True):
                found = both.encode(value.as_py())
                ids.append(name.as_py())
                tokens.append(found)
                size += len(found[0]) + len(found[1])
                if size > BATCH_TOKENS:
                    yield _aligned_batch(both, ids, tokens)
                    ids, tokens, size = [], [], 0
        if ids:
            yield _aligned_batch(both, ids, tokens)

    return batches


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))


def align(docs: DataFrame, files, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with ``id``, the token ids ``a`` and ``b``, and the number of tokens
    of each group on either side, ``a_sizes`` and ``b_sizes``, in order.

    A document without text, or whose tokens of either side do not give back a space and its
    text, has empty lists. Repeated rows and null ids are documents like any other; other columns
    of ``docs`` are not read. A text is encoded in chunks, so a long one costs no more than its
    length and the memory of its ids; only a run without single spaces is encoded at once.
    """
    return _texts(docs, doc_id, text).mapInArrow(_align(files), ALIGNED)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of all lists, and where each list starts, with the end last."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.int64), offsets - offsets[0]


def _spelling(n_a: int, n_b: int) -> np.ndarray:
    """What follows each id in the text of all groups: four times the ids."""
    words = [f"{n}{after}" for size, ends in ((n_a, ",|"), (n_b, ",;")) for after in ends for n in range(size)]
    return np.array(words, object)


def _digest(files) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of ``ALIGNED`` to batches of ``DIGESTS``."""

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, pairs = _loaded(*files.value)
        n_a, n_b = len(both.a_bytes), len(both.b_bytes)
        words = _spelling(n_a, n_b)
        for frame in frames:
            a, a_at = _flat(frame.column(1))
            b, b_at = _flat(frame.column(2))
            a_sizes, g_at = _flat(frame.column(3))
            b_sizes, _ = _flat(frame.column(4))
            a_last, b_last = np.cumsum(a_sizes) - 1, np.cumsum(b_sizes) - 1
            # In each group the last tokens of both sides, and only they, end together.
            links = np.searchsorted(pairs, a[a_last] * n_b + b[b_last])
            # Where each token comes in the text: all of A's of a group, then all of B's.
            before_a = np.repeat(np.cumsum(b_sizes) - b_sizes, a_sizes)
            before_b = np.repeat(np.cumsum(a_sizes), b_sizes)
            spelled = np.empty(len(a) + len(b), np.int64)
            ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
            ends_a[a_last] = n_a
            ends_b[b_last] = n_b
            spelled[np.arange(len(a)) + before_a] = a + ends_a
            spelled[np.arange(len(b)) + before_b] = b + ends_b + 2 * n_a
            shas = []
            for first, last in zip((a_at + b_at)[:-1].tolist(), (a_at + b_at)[1:].tolist(), strict=True):
                text = "".join(words[spelled[first:last]])
                shas.append(hashlib.sha256(text[:-1].encode()).hexdigest() if text else "")
            counts = np.diff(g_at)
            yield pa.RecordBatch.from_arrays(
                [
                    frame.column(0),
                    pa.array(np.diff(a_at), pa.int64()),
                    pa.array(np.diff(b_at), pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(shas, pa.string()),
                    _lists(links, counts),
                ],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"],
            )

    return batches


def digest(aligned: DataFrame, files) -> DataFrame:
    """Counts of tokens, groups and links of each document, its links as numbers of pairs, and
    the SHA-256 of its groups spelled out: ids joined by commas, A's before B's with a bar
    between, groups joined by semicolons; empty without tokens."""
    return aligned.mapInArrow(_digest(files), DIGESTS)


def aligned_digests(docs: DataFrame, files, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``digest(align(...))``, whose lists of tokens then stay inside one worker."""
    aligned, digested = _align(files), _digest(files)
    return _texts(docs, doc_id, text).mapInArrow(lambda frames: digested(aligned(frames)), DIGESTS)


def pair_counts(digests: DataFrame) -> DataFrame:
    """How many links of all documents hold each pair: (pair, n)."""
    return digests.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))


def rate(digests: DataFrame, files, scratch: Scratch) -> DataFrame:
    """``digests`` with, in place of the links, ``n_best`` (links whose pair is the most frequent
    one of its id of B, ties included) and ``count_sum`` (the counts of all its links)."""
    counted = scratch.cut(pair_counts(digests), "pairs")
    both, pairs = _loaded(*files.value)
    counts = np.zeros(len(pairs), np.int64)
    # One number for each pair that the vocabularies allow.
    table = counted.toPandas()
    counts[table["pair"].to_numpy(np.int64)] = table["n"].to_numpy(np.int64)
    of_b = pairs % len(both.b_bytes)
    most = np.zeros(len(both.b_bytes), np.int64)
    np.maximum.at(most, of_b, counts)
    known = digests.sparkSession.sparkContext.broadcast((counts, counts == most[of_b]))
    others = [c for c in digests.columns if c != "links"]

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = known.value
        for frame in frames:
            links, at = _flat(frame.column(frame.schema.get_field_index("links")))
            sums = np.concatenate(([0], np.cumsum(counts[links])))
            bests = np.concatenate(([0], np.cumsum(best[links])))
            yield pa.RecordBatch.from_arrays(
                [*(frame.column(frame.schema.get_field_index(c)) for c in others), pa.array(np.diff(bests[at]), pa.int64()), pa.array(np.diff(sums[at]), pa.int64())],
                names=[*others, "n_best", "count_sum"],
            )

    fields = ", ".join(f"{n} {t}" for n, t in digests.dtypes if n != "links")
    return digests.mapInArrow(batches, f"{fields}, n_best long, count_sum long")


def alignment_query(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the table, aligned; see ``align`` for texts without tokens."""
    scratch = Scratch(spark)
    files = read_tokenizers(spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    # Written once: the links are read for the counts and for the documents.
    digests = scratch.cut(aligned_digests(docs, files), "digests")
    return rate(digests, files, scratch)
