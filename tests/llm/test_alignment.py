"""Alignment against a plain count over the tokenizers' own output."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tillroll.llm import alignment
from tillroll.llm.alignment import CHUNK_CHARS, Tokenizers, align, alignment_query, coalesce, digest, rate, read_tokenizers

SF = "/root/testdata/sf0.001"
A, B = Path(alignment.FOLDER, alignment.A_FILE), Path(alignment.FOLDER, alignment.B_FILE)


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(str(A))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=str(B))


def brute(plain, rows):
    """Every count of the contract, pair by pair, without sorting or numbering."""
    a, b = plain
    letters = alignment._byte_letters()
    entries = {n: bytes(letters[c] for c in e) for e, n in a.get_vocab(with_added_tokens=False).items() if all(c in letters for c in e)}
    pieces = [b.id_to_piece(n) for n in range(b.get_piece_size())]
    spelled = [bytes([int(p[3:5], 16)]) if b.is_byte(n) else p.replace("▁", " ").encode() for n, p in enumerate(pieces)]
    found, counts = [], Counter()
    for name, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if b"".join(entries[i] for i in ids_a) != whole or b"".join(spelled[i] for i in ids_b) != whole:
            ids_a, ids_b = [], []
        at, ends_a, ends_b = 0, [], []
        for i in ids_a:
            at += len(entries[i])
            ends_a.append(at)
        at = 0
        for i in ids_b:
            at += len(spelled[i])
            ends_b.append(at)
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, links, low = [], [], 0
        for cut in cuts:
            left = [i for i, e in zip(ids_a, ends_a, strict=True) if low < e <= cut]
            right = [i for i, e in zip(ids_b, ends_b, strict=True) if low < e <= cut]
            groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
            low = cut
        by_end = defaultdict(list)
        for y, f in zip(ids_b, ends_b, strict=True):
            by_end[f].append(y)
        links = [(x, y) for x, e in zip(ids_a, ends_a, strict=True) for y in by_end[e]]
        counts.update(links)
        found.append((name, len(ids_a), len(ids_b), groups, links))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for name, n_a, n_b, groups, links in found:
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        good = sum(counts[p] == best[p[1]] for p in links)
        out.append((name, n_a, n_b, len(groups), len(links), good, sum(counts[p] for p in links), sha))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def run(spark, scratch, docs):
    files = read_tokenizers(spark)
    found = rate(scratch.cut(digest(align(docs, files), files), "digests"), files, scratch)
    return sorted((tuple(r[c] for c in COLUMNS) for r in found.collect()), key=repr)


CASES = [
    (1, "Hello world, it's 2024!"),
    (2, ""),
    (3, None),
    (4, "été naïve — ▁marked"),
    (5, "<|endoftext|> and <s> stay plain"),
    (6, "  two  blanks\n\n\tand a tab "),
    (7, "日本語 text 😀 mixed ́"),
    (7, "日本語 text 😀 mixed ́"),
    (None, "no id here"),
    (8, "x\x00y \x1c z\x7f"),
    (9, " non breaking   blanks"),
]


def test_cases_equal_the_brute_force(spark, scratch, plain):
    docs = spark.createDataFrame(CASES, "doc_id long, text string")
    assert run(spark, scratch, docs) == brute(plain, CASES)


def test_other_columns_and_an_empty_table(spark, scratch):
    docs = spark.createDataFrame([(1, "a b", "x", 5)], "doc_id long, text string, a string, n_links int")
    assert len(run(spark, scratch, docs)) == 1
    assert run(spark, scratch, docs.limit(0)) == []


def test_table_equals_the_brute_force(spark, scratch, plain):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    # The plain count takes the square of a text's tokens.
    short = [r for r in rows if not r[1] or len(r[1]) < 1500][:60]
    docs = spark.createDataFrame(short, "doc_id long, text string")
    assert run(spark, scratch, docs) == brute(plain, short)
    found = {r["doc_id"]: r for r in alignment_query(spark, SF).collect()}
    assert len(found) == len(rows)
    by_id = {r[0]: r for r in brute(plain, short)}
    for name, row in by_id.items():
        assert (found[name]["n_a"], found[name]["n_b"], found[name]["n_groups"], found[name]["groups_sha256"]) == (row[1], row[2], row[3], row[7])


def test_long_texts_are_encoded_like_whole_ones(plain):
    both = Tokenizers(A.read_bytes(), B.read_bytes())
    a, b = plain
    long = ("some words, don't stop 12 34;  two blanks\n" * 2000) + "x" * 3 * CHUNK_CHARS + " end 'll go"
    found = both.encode(long)
    assert found == (a.encode(" " + long, add_special_tokens=False).ids, b.encode(long))


def test_links_only_join_suffixes():
    both = Tokenizers(A.read_bytes(), B.read_bytes())
    size = len(both.b_bytes)
    pairs = both.pairs
    assert len(pairs) <= sum(map(len, both.a_bytes)) + 2 * sum(map(len, both.b_bytes))
    rng = np.random.default_rng(1)
    for code in rng.choice(pairs, 200):
        a, b = both.a_bytes[code // size], both.b_bytes[code % size]
        assert a.endswith(b) or b.endswith(a)


def test_groups_break_where_both_end():
    a, b = coalesce(np.array([2, 3, 1]), np.array([1, 1, 2, 2]))
    assert a.tolist() == [0, 1, 1]
    assert b.tolist() == [0, 0, 1, 1]
    a, b = coalesce(np.array([1, 1, 1]), np.array([3]))
    assert (a.tolist(), b.tolist()) == ([0, 0, 0], [0])
    assert [x.tolist() for x in coalesce(np.zeros(0, int), np.zeros(0, int))] == [[], []]
