"""Collocations against a plain count, and their SQL."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard

from tillroll.llm import collocations as module
from tillroll.llm.collocations import HEAD, PHRASE, REST, _lockstep, collocations

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, min_count=10, top=2000, share=50):
    counts, totals = {}, Counter()
    for lang, text in rows:
        own = counts.setdefault(lang or "und" if lang is None else lang, Counter())
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    own[tuple(words[i : i + size])] += 1
    out = []
    for lang, own in counts.items():
        totals[lang] = sum(n for g, n in own.items() if len(g) == 1)
        candidates = {g: n for g, n in own.items() if len(g) > 1 and n >= min_count}
        found = []
        for g, a in candidates.items():
            if any(len(h) == 3 and len(g) == 2 and g in (h[:2], h[1:]) and 100 * n >= share * a for h, n in candidates.items()):
                continue
            cuts = [(1000000 * a * a // (own[g[:k]] * own[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(g).encode(), " ".join(g), a, own[g[:k]], own[g[k:]], score))
        for rank, x in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, x[3], x[4], x[5], x[6], totals[lang], x[7]))
    return sorted(out)


def run(spark, scratch, rows, **settings):
    docs = spark.createDataFrame([(n, t, g, "x") for n, (g, t) in enumerate(rows)], "doc_id long, text string, lang string, phrase string")
    return sorted(tuple(r[c] for c in COLUMNS) for r in collocations(docs, scratch, **settings).collect())


def random_rows(seed, documents, words):
    rng = np.random.default_rng(seed)
    vocabulary = ["a", "B", "c\x01", "é", "c", "of", "the", "New", "york", "x\x7f", "日本"] + [f"w{n}" for n in range(60)]
    marks = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "!x ", "\r"]
    rows = []
    for _ in range(documents):
        picked = vocabulary[: 11] if rng.random() < 0.3 else vocabulary
        text = "".join(str(rng.choice(picked)) + str(rng.choice(marks)) for _ in range(int(rng.integers(0, words))))
        rows.append((None if rng.random() < 0.1 else str(rng.choice(["en", "de"])), text))
    return rows


def test_counts_equal_the_brute_force(spark, scratch):
    rows = [*random_rows(1, 150, 120), (None, None), ("en", ""), ("fr", " .,! "), ("und", "the of the of the of the of the of the of the of the of the of the of the")]
    rows += [("en", "New york city hall")] * 12
    assert run(spark, scratch, rows) == brute(rows)
    assert run(spark, scratch, rows, top=7) == brute(rows, top=7)
    assert run(spark, scratch, rows, min_count=2, absorb_percent=90) == brute(rows, 2, 2000, 90)


def test_small_blocks_and_ranges_count_the_same(spark, scratch):
    # Patched values have to reach the workers, so blocks are made here.
    rows = random_rows(2, 30, 200)
    frame = pa.RecordBatch.from_arrays(
        [pa.array([g or "und" for g, _ in rows]), pa.array([t.encode() for _, t in rows], pa.binary())], names=["lang", "text"]
    )
    whole = (module.BLOCK_WORDS, module.PIECE_BYTES)
    try:
        module.BLOCK_WORDS, module.PIECE_BYTES = 40, 16
        captured = []

        class Slim:
            def select(self, *_):
                return self

            def mapInArrow(self, f, _):
                captured.append(f)
                return None

        module._blocks(Slim(), "lang", "text")
        made = list(captured[0](iter([frame])))
    finally:
        module.BLOCK_WORDS, module.PIECE_BYTES = whole
    counts = Counter()
    for batch in made:
        row = batch.to_pylist()[0]
        words = [None, *row["words"]]
        ids = np.frombuffer(zstandard.decompress(row["ids"]), "<i4")
        for size in (1, 2, 3):
            for end in range(row["context"], len(ids)):
                gram = ids[end - size + 1 : end + 1] if end - size + 1 >= 0 else []
                if len(gram) == size and all(gram):
                    counts[(row["lang"], *(words[i] for i in gram))] += 1
    plain = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    plain[(lang or "und", *words[i : i + size])] += 1
    assert counts == plain
    assert len(made) > 60


def test_a_stream_may_be_cut_anywhere():
    rng = np.random.default_rng(3)
    counts = {}
    for a in range(1, 5):
        counts[a, 0, 0] = int(rng.integers(50, 99))
        for b in rng.choice(9, 4, replace=False) + 1:
            counts[a, int(b), 0] = int(rng.integers(20, 50))
            for c in rng.choice(9, int(rng.integers(0, 5)), replace=False) + 1:
                counts[a, int(b), int(c)] = int(rng.integers(10, 20))
    rows = [(*k, n) for k, n in sorted(counts.items())]
    names = ["k1", "k2", "k3", "f"]

    def batches(part, size):
        for i in range(0, len(part), size):
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in part[i : i + size]], pa.int64()) for k in range(4)], names=names)

    wanted = sorted(
        (a, b, c, n, counts[a, 0, 0], counts[a, b, 0] if c else None, 0 if c else max([m for (x, y, z), m in counts.items() if (x, y) == (a, b) and z], default=0))
        for (a, b, c), n in counts.items() if b
    )
    for cut in range(0, len(rows) + 1, 3):
        for size in (1, 4, 1000):
            out = [r for part in (rows[:cut], rows[cut:]) for f in _lockstep(batches(part, size)) for r in f.to_pylist()]
            words = {r["k1"]: r["f"] for r in out if r["kind"] == HEAD and not r["k2"]}
            pairs = {(r["k1"], r["k2"]): r["f"] for r in out if r["kind"] == HEAD and r["k2"]}
            rests = {(r["k1"], r["k2"]): r["longest"] for r in out if r["kind"] == REST}
            found = []
            for r in out:
                if r["kind"] == PHRASE:
                    key = (r["k1"], r["k2"])
                    one = words[r["k1"]] if r["one"] is None else r["one"]
                    two = (pairs[key] if r["two"] is None else r["two"]) if r["k3"] else None
                    longest = 0 if r["k3"] else max(r["longest"], rests.get(key, 0))
                    found.append((*key, r["k3"], r["f"], one, two, longest))
            assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_large_counts_stay_exact(spark):
    frame = spark.createDataFrame([(900_000_000_000, 999_999_999_989, 999_999_999_961)], "a long, l long, r long")
    found = frame.select(module._score("a", "l", "r").alias("s")).first()["s"]
    assert found == 1000000 * 900_000_000_000**2 // (999_999_999_989 * 999_999_999_961)


def test_empty_table(spark, scratch):
    assert run(spark, scratch, []) == []
