"""Language ID of code-switched text with a linear-chain conditional random field.

Each word (a run of letters) gets a label. A word's score is the sum of learned weights of its
character trigrams, prefix, suffixes and lexicon entry; learned transitions say how often one
language follows another; forward-backward gives the label probabilities. Chains run over
stretches of ``CHAIN`` words, so that texts of any length fill the same matrices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import TRAIN_CHARS, hash_sample, release_memory

BUCKET_BITS = 17
CHAIN = 64
PIECE_CHARS = 200_000  # how much of a long text is in memory at once
UNKNOWN = "und"

# Training sample: bounded, whatever the size of the corpus. Every language takes part; beyond
# MANY_LANGUAGES each has fewer documents, and more than MAX_LANGUAGES are an error, because the
# weights no longer fit the driver.
TRAIN_DOCS_PER_LANGUAGE, LEAST_DOCS_PER_LANGUAGE = 150, 8
TRAIN_CHAINS_PER_DOC = 12
TRAIN_CELLS = 4_000_000  # words times languages in memory at once
MANY_LANGUAGES, MAX_LANGUAGES = 16, 256
ROUNDS = 14
RATE = 0.35

_LETTER = np.fromiter((chr(c).isalpha() for c in range(0x30000)), bool, 0x30000)
_POWERS = np.cumprod(np.full(64, 0x9E3779B1, np.uint64), dtype=np.uint64)

RESULT = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    weights: np.ndarray  # (buckets, languages)
    transitions: np.ndarray  # (languages, languages)


@dataclass(frozen=True)
class _Words:
    """Words of some texts: buckets of their trigrams, and of their word-level features."""

    trigrams: np.ndarray
    offsets: np.ndarray
    lengths: np.ndarray
    features: np.ndarray  # (words, kinds)
    text: np.ndarray  # which text a word is of


def _bucket(hashes: np.ndarray, seed: int) -> np.ndarray:
    mixed = (hashes.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def _words(texts: list[str]) -> _Words:
    """All words of ``texts``, without a Python loop over words."""
    lowered = [t.lower() + "\n" for t in texts]
    ends_of_texts = np.cumsum([len(t) for t in lowered])
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _LETTER[np.minimum(codes, len(_LETTER) - 1)]
    chars = np.zeros(len(codes) + 2, np.uint64)
    chars[1:-1] = np.where(is_letter, codes, 0)
    steps = np.diff(np.concatenate(([0], is_letter.view(np.int8), [0])))
    starts, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    lengths = ends - starts
    at = np.flatnonzero(is_letter)
    offsets = np.cumsum(lengths) - lengths
    here, before, after = chars[at + 1], chars[at], chars[at + 2]
    trigrams = _bucket(before * np.uint64(0x1000193) + here * np.uint64(0x85EBCA6B) + after * np.uint64(0xC2B2AE35), 1)
    if not len(starts):
        none = np.zeros(0, np.int32)
        return _Words(none, none, none, np.zeros((0, 4), np.int32), none)

    def char(position: np.ndarray, present: np.ndarray) -> np.ndarray:
        return np.where(present, chars[np.clip(position, 0, len(chars) - 1)], 0).astype(np.uint64)

    first, last = starts + 1, ends
    prefix = (char(first, lengths > 0) << np.uint64(42)) + (char(first + 1, lengths > 1) << np.uint64(21)) + char(first + 2, lengths > 2)
    suffix2 = (char(last, lengths > 0) << np.uint64(21)) + char(last - 1, lengths > 1)
    suffix3 = (suffix2 << np.uint64(21)) + char(last - 2, lengths > 2)
    place = np.minimum(np.arange(len(at)) - np.repeat(offsets, lengths), 63)
    whole = np.add.reduceat(here * _POWERS[place], offsets)
    features = np.stack(
        [_bucket(h, seed) for h, seed in ((prefix, 2), (suffix2, 3), (suffix3, 4), (whole, 5))], 1
    )
    return _Words(trigrams, offsets, lengths, features, np.searchsorted(ends_of_texts, starts, "right"))


def _emissions(words: _Words, weights: np.ndarray) -> np.ndarray:
    scores = np.add.reduceat(weights[words.trigrams], words.offsets, axis=0)
    for kind in range(words.features.shape[1]):
        scores += weights[words.features[:, kind]]
    return scores


def _chains(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Row and column of every word in a matrix of chains; chains do not cross texts."""
    new = np.concatenate(([True], text[1:] != text[:-1]))
    place = np.arange(len(text)) - np.maximum.accumulate(np.where(new, np.arange(len(text)), 0))
    row = np.cumsum(place % CHAIN == 0) - 1
    return row, place % CHAIN, int(row[-1]) + 1


def _forward_backward(scores: np.ndarray, row: np.ndarray, column: np.ndarray, chains: int, transitions: np.ndarray):
    """Label probabilities of every word, and the expected transitions summed over all chains."""
    labels = scores.shape[1]
    potential = np.ones((CHAIN, chains, labels), np.float32)
    present = np.zeros((CHAIN, chains), bool)
    potential[column, row] = np.exp(scores - scores.max(1, keepdims=True))
    present[column, row] = True
    moves = np.exp(transitions - transitions.max()).astype(np.float32)
    forward = np.empty_like(potential)
    forward[0] = potential[0] / potential[0].sum(1, keepdims=True)
    for t in range(1, CHAIN):
        step = (forward[t - 1] @ moves) * potential[t]
        forward[t] = step / np.maximum(step.sum(1, keepdims=True), 1e-30)
    backward = np.ones_like(potential)
    expected = np.zeros((labels, labels))
    for t in range(CHAIN - 2, -1, -1):
        ahead = potential[t + 1] * backward[t + 1]
        step = ahead @ moves.T
        step /= np.maximum(step.sum(1, keepdims=True), 1e-30)
        pair = forward[t].T @ (ahead * present[t + 1][:, None] / np.maximum(
            ((forward[t] @ moves) * ahead).sum(1, keepdims=True), 1e-30))
        expected += pair * moves
        backward[t] = np.where(present[t + 1][:, None], step, 1.0)
    both = forward * backward
    both /= np.maximum(both.sum(2, keepdims=True), 1e-30)
    return both[column, row], expected


def train(texts: list[str], labels: list[str], seed: int = 7) -> LanguageModel:
    """Fit by gradient ascent on the likelihood of labelled words.

    A document's label holds for all its words. Half chains of different documents are put
    together, so that the transitions also see changes of language.
    """
    languages = tuple(sorted(set(labels)))
    number = {name: i for i, name in enumerate(languages)}
    words = _words(texts)
    if not len(words.offsets):
        return LanguageModel(languages, np.zeros((1 << BUCKET_BITS, len(languages)), np.float32), np.eye(len(languages)))
    truth = np.array([number[x] for x in labels], np.int64)[words.text]
    half = CHAIN // 2
    random = np.random.default_rng(seed)
    pieces = []
    for start, end in zip(*_bounds(words.text), strict=True):
        cuts = [np.arange(a, min(a + half, end)) for a in range(start, end, half)]
        keep = random.permutation(len(cuts))[: 2 * TRAIN_CHAINS_PER_DOC]
        pieces += [cuts[i] for i in sorted(keep)]
    order = np.concatenate([pieces[i] for i in random.permutation(len(pieces))])
    chain_of = np.arange(len(order)) // CHAIN
    truth = truth[order]
    lots = []
    size = max(1, TRAIN_CELLS // (CHAIN * len(languages))) * CHAIN
    for start in range(0, len(order), size):
        part = slice(start, start + size)
        lots.append((truth[part], _take(words, order[part]), _chains(chain_of[part])))
    same_chain = chain_of[1:] == chain_of[:-1]
    seen = np.zeros((len(languages),) * 2)
    np.add.at(seen, (truth[:-1][same_chain], truth[1:][same_chain]), 1)

    weights = np.zeros((1 << BUCKET_BITS, len(languages)), np.float32)
    transitions = np.zeros((len(languages),) * 2)
    steps, moved = np.full_like(weights, 1e-6), np.full_like(transitions, 1e-6)
    for _ in range(ROUNDS):
        gradients, expected = np.zeros(weights.shape[::-1]), np.zeros_like(transitions)
        for labelled, kept, (row, column, chains) in lots:
            chance, moves = _forward_backward(_emissions(kept, weights), row, column, chains, transitions)
            expected += moves
            error = -chance
            error[np.arange(len(labelled)), labelled] += 1
            spread = np.repeat(np.arange(len(labelled)), kept.lengths)
            for label in range(len(languages)):
                own = error[:, label]
                gradients[label] += np.bincount(kept.trigrams, own[spread], 1 << BUCKET_BITS)
                for kind in range(kept.features.shape[1]):
                    gradients[label] += np.bincount(kept.features[:, kind], own, 1 << BUCKET_BITS)
        for label, gradient in enumerate(gradients):
            steps[:, label] += gradient**2
            weights[:, label] += RATE * gradient / np.sqrt(steps[:, label])
        gradient = seen - expected
        moved += gradient**2
        transitions += RATE * gradient / np.sqrt(moved)
    return LanguageModel(languages, weights, transitions)


def _bounds(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
    return starts, np.append(starts[1:], len(text))


def _take(words: _Words, order: np.ndarray) -> _Words:
    lengths = words.lengths[order]
    offsets = np.cumsum(lengths) - lengths
    inside = np.arange(lengths.sum()) - np.repeat(offsets, lengths)
    trigrams = words.trigrams[np.repeat(words.offsets[order], lengths) + inside]
    return _Words(trigrams, offsets, lengths, words.features[order], words.text[order])


def _pieces(texts: list[str], chars: int) -> Iterator[tuple[list[int], list[str]]]:
    """Texts in lots of about ``chars``; a long text comes in several lots, cut at blanks."""
    numbers: list[int] = []
    lot: list[str] = []
    size = 0
    for i, text in enumerate(texts):
        start = 0
        while start < len(text):
            end = start + chars
            if end < len(text):
                blank = text.find(" ", end, end + 1000)
                end = blank if blank > 0 else end
            numbers.append(i)
            lot.append(text[start:end])
            size += len(lot[-1])
            start = end
            if size >= chars:
                yield numbers, lot
                numbers, lot, size = [], [], 0
    if lot:
        yield numbers, lot


def word_shares(texts: list[str], model: LanguageModel) -> np.ndarray:
    """Expected number of words of each language in each text."""
    shares = np.zeros((len(texts), len(model.languages)))
    if not model.languages:
        return shares
    chars = PIECE_CHARS * MANY_LANGUAGES // max(MANY_LANGUAGES, len(model.languages))
    for numbers, lot in _pieces(texts, chars):
        words = _words(lot)
        if len(words.offsets):
            scores = _emissions(words, model.weights)
            chance, _ = _forward_backward(scores, *_chains(words.text), model.transitions)
            np.add.at(shares, np.asarray(numbers)[words.text], chance)
    return shares


def sample_for_training(docs: DataFrame, usable=None) -> DataFrame:
    """At most ``TRAIN_DOCS_PER_LANGUAGE`` labelled texts of every language, chosen by hash; fewer
    of each, if there are more than ``MANY_LANGUAGES``."""
    rows = docs.select("text", "lang", *([usable.alias("_ok")] if usable is not None else []))
    rows = rows.filter("text is not null and lang is not null")
    if usable is not None:
        rows = rows.filter("_ok")
    languages = rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).count()
    if languages > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} different values of lang; none is left out, so map them to fewer")
    size = TRAIN_DOCS_PER_LANGUAGE
    if languages > MANY_LANGUAGES:
        size = max(LEAST_DOCS_PER_LANGUAGE, size * MANY_LANGUAGES // languages)
    return hash_sample(rows, F.xxhash64("text"), ["lang"], size, MAX_LANGUAGES).select(F.left("text", F.lit(TRAIN_CHARS)).alias("text"), "lang")


def fit(docs: DataFrame, usable=None) -> LanguageModel:
    """Train on the bounded sample; without any labelled text, a model without languages."""
    sample = sample_for_training(docs, usable).orderBy("lang", "text").collect()
    return train([r["text"] for r in sample], [r["lang"] for r in sample])


def identify_language(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, replacing columns of these names.

    The language is the one with most expected words, ties to the first by name; the score is
    its share of the words. A text that is null, empty or without letters, and every text if
    the model knows no language, gets ``und`` and 0. Rows are judged by their text alone, so
    repeated rows and other columns, null or not, make no difference. Texts are read whole.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # buckets x languages, both bounded

    @F.pandas_udf(RESULT)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            shares = word_shares([t or "" for t in batch], known)
            total = shares.sum(1) if known.languages else np.zeros(len(batch))
            found = total > 0
            best = shares.argmax(1) if known.languages else np.zeros(len(batch), int)
            score = np.divide(shares[np.arange(len(batch)), best], total, out=np.zeros(len(batch)), where=found) if known.languages else total
            names = [known.languages[b] if f else UNKNOWN for b, f in zip(best, found, strict=True)]
            yield pd.DataFrame({"lang_pred": names, "score": np.clip(score, 0.0, 1.0)})
        release_memory()

    judged = docs.drop("lang_pred", "score").withColumn("_language", judge.asNondeterministic()(F.col(text)))
    return judged.select("*", "_language.lang_pred", "_language.score").drop("_language")


def held_out(doc_id: str = "doc_id"):
    """A fixed quarter of the documents; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2


def language_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = fit(docs, ~held_out())
    judged = identify_language(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
