"""Line dedup, near-dup and suffix dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pandas as pd
import pytest

from tests.conftest import rows
from tillroll.llm import line_dedup, near_dup, suffix_dedup

DOCS = "doc_id long, text string"


def frame(spark, data, schema=DOCS):
    return spark.createDataFrame(data, schema)


# -- line dedup --------------------------------------------------------------------------------


def brute_lines(docs, min_words):
    """Every run of lines with enough words, at every place."""
    unique = sorted(set(docs), key=lambda d: (d[0] is None, d[0] or 0, hashlib.sha256((d[1] or "").encode()).hexdigest()))
    places = {}
    for d, (_, text) in enumerate(unique):
        lines = [] if text is None else text.split("\n")
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                if sum(len(x.split()) for x in lines[i:j]) >= min_words:
                    places.setdefault(tuple(lines[i:j]), []).append((d, i))
    gone = {}
    for run, where in places.items():
        for d, i in sorted(where)[1:]:
            gone.setdefault(d, set()).update(range(i, i + len(run)))
    return {
        u: None if u[1] is None else "\n".join(x for i, x in enumerate(u[1].split("\n")) if i not in gone.get(d, ()))
        for d, u in enumerate(unique)
    }


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup_equals_brute_force(spark, scratch, seed):
    rng = random.Random(seed)
    words = ["a b", "c", "d e f", "", "g h"]
    docs = [(i, "\n".join(rng.choice(words) for _ in range(rng.randint(1, 12)))) for i in range(14)]
    docs += [(20, docs[0][1]), (None, docs[1][1]), (21, None), (22, "")]
    found = line_dedup.dedup_lines(frame(spark, docs), scratch, min_words=4)
    expected = brute_lines(docs, 4)
    assert rows(found.select("doc_id", "text")) == sorted([(d[0], expected[d]) for d in docs], key=repr)


def test_short_lines_go_if_they_are_frequent(spark, scratch):
    footer, rare, tiny = "all of this may be shared freely", "a line of just five", "too short"
    docs = [(n, "\n".join([f"text number {n}", footer, tiny, rare if n % 25 == 0 else f"end {n}", footer])) for n in range(60)]
    found = {r["doc_id"]: r for r in line_dedup.dedup_lines(frame(spark, docs), scratch, min_words=50).collect()}
    # 120 copies of seven words are 840 words, three of five are 15.
    for n, text in docs:
        lines = text.split("\n")
        kept = lines[:4] if n == 0 else [x for x in lines if x != footer]
        assert found[n]["text"] == "\n".join(kept), n
    none = line_dedup.dedup_lines(frame(spark, docs), scratch, min_words=50, short_mass=841)
    assert none.agg({"n_removed": "sum"}).first()[0] == 0


def test_long_texts_lose_lines_in_linear_time(spark, scratch):
    import time

    line = "a line that is long enough to count as frequent in a text"
    text = "\n".join(x for n in range(50_000) for x in (f"line {n}", line))
    started = time.perf_counter()
    [row] = line_dedup.dedup_lines(frame(spark, [(1, text)]), scratch).collect()
    assert (row["n_lines"], row["n_removed"]) == (100_000, 49_999)
    assert row["text"] == "\n".join(["line 0", line, *(f"line {n}" for n in range(1, 50_000))])
    assert time.perf_counter() - started < 90


def test_line_dedup_edges(spark, scratch):
    long = "\n".join(f"line {i} of the long text" for i in range(300))
    data = [(1, long, 5, 9), (2, long, None, 8), (2, long, None, 8), (3, None, 1, 7), (4, "", 1, 6)]
    docs = frame(spark, data, "doc_id long, text string, n_lines int, doc int")
    found = {(r.doc_id, r.doc): r for r in line_dedup.dedup_lines(docs, scratch).collect()}
    assert found[1, 9].text == long and found[1, 9].n_lines == 300
    assert found[2, 8].text == "" and found[2, 8].n_removed == 300
    assert found[3, 7].text is None and found[3, 7].n_lines == 0
    assert found[4, 6].text == "" and found[4, 6].n_lines == 1
    assert line_dedup.dedup_lines(docs, scratch).count() == 5
    assert line_dedup.dedup_lines(docs.limit(0), scratch).count() == 0




# -- near duplicates ---------------------------------------------------------------------------


def brute_near(docs, size, percent):
    sets = []
    for _, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or ""))
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
        sets.append({tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    root = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and root[i] != root[j]:
                root = [root[j] if r == root[i] else r for r in root]
    out = []
    for i, (doc, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if root[j] == root[i] and docs[j][0] is not None]
        out.append((doc, len(sets[i]), (min(ids) if ids else None) if sets[i] else doc))
    return sorted(out, key=repr)


def near_rows(spark, scratch, docs, size, percent):
    found, placed = near_dup.near_duplicates(frame(spark, docs), scratch, shingle_words=size, min_percent=percent)
    joined = found.join(placed, "class", "left")
    return sorted(
        ((r["id"], r["n_shingles"], r["component_id"] if r["class"] is not None else r["id"]) for r in joined.collect()),
        key=repr,
    )


def edited(rng, words, share):
    return " ".join(w if rng.random() > share else f"new{rng.random()}" for w in words)


def test_near_dup_equals_brute_force(spark, scratch):
    rng = random.Random(3)
    docs = []
    for _ in range(25):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(1, 160))]
        docs += [(len(docs) + k, edited(rng, words, share)) for k, share in enumerate((0, 0.004, 0.01, 0.03))]
    docs += [(200, docs[0][1].upper()), (None, docs[4][1]), (201, None), (202, " \n"), (203, "x"), (204, "X"), (4, docs[4][1])]
    assert near_rows(spark, scratch, docs, 3, 85) == brute_near(docs, 3, 85)


def test_near_dup_of_large_nodes(spark, scratch, monkeypatch):
    """Groups beyond the size of a node: branches, random parts and blocks."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    docs = [(i, edited(rng, base, 0.012)) for i in range(90)]
    docs += [(100 + i, edited(rng, base[:100] + [f"v{i}" for i in range(60)], 0.004)) for i in range(40)]
    more = docs + [(1000 + i, edited(rng, base, 0.012)) for i in range(320)]
    assert near_rows(spark, scratch, more, 3, 85) == brute_near(more, 3, 85)
    monkeypatch.setattr(near_dup, "NODE_CLASSES", 12)
    assert near_rows(spark, scratch, docs, 3, 85) == brute_near(docs, 3, 85)


def test_near_dup_stage_keeps_one_of_each_group(spark, scratch):
    words = " ".join(f"w{i}" for i in range(50))
    data = [(1, words, "a"), (2, words + " end", None), (2, words + " end", None), (3, "alone", "b"), (4, None, "c"), (5, "", "d"), (6, "", "d"), (None, words, "e")]
    docs = frame(spark, data, "doc_id long, text string, class string")
    kept = near_dup.drop_near_duplicates(docs, scratch)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5, 6]
    assert near_dup.drop_near_duplicates(docs.limit(0), scratch).count() == 0
    same = frame(spark, [(7, words), (7, words), (None, "x y"), (None, "x y")])
    assert near_dup.drop_near_duplicates(same, scratch).count() == 2


# -- suffix dedup ------------------------------------------------------------------------------


def brute_bytes(docs):
    size, seen = suffix_dedup.LENGTH, {}
    texts = [(t or "").encode() for _, t in docs]
    for text in texts:
        for i in range(len(text) - size + 1):
            window = text[i : i + size]
            seen[window] = seen.get(window, 0) + 1
    out = []
    for (doc, _), text in zip(docs, texts, strict=True):
        gone = bytearray(len(text))
        for i in range(len(text) - size + 1):
            if seen[text[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        kept = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((doc, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def suffix_rows(spark, scratch, docs):
    found = suffix_dedup.remove_repeats(frame(spark, docs), scratch)
    return sorted(
        ((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in found.collect()),
        key=repr,
    )


def passages(seed):
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choice("abcdefé ") for _ in range(n))
    shared = [noise(n) for n in (390, 399, 400, 401, 520, 900, 1500)]
    docs = []
    for i in range(40):
        parts = []
        for _ in range(rng.randint(0, 4)):
            source = rng.choice(shared)
            start = rng.randint(0, 60)
            parts += [noise(rng.randint(0, 300)), source[start : len(source) - rng.randint(0, 60)]]
        docs.append((i, "".join(parts) + noise(50)))
    docs += [(50, docs[1][1]), (51, docs[1][1]), (52, "ab" * 900), (53, "x" * 1000), (54, "x" * 399)]
    return docs + [(None, docs[3][1]), (55, None), (56, ""), (57, "é" * 300)]


@pytest.mark.parametrize("classes", [16_384, 2])
def test_suffix_dedup_equals_brute_force(spark, scratch, monkeypatch, classes):
    monkeypatch.setattr(suffix_dedup, "GROUP_CLASSES", classes)
    docs = passages(classes)
    assert suffix_rows(spark, scratch, docs) == brute_bytes(docs)


def test_both_ways_to_compare_classes_agree():
    """The suffix sort, and the hashes of windows, on the contexts of one anchor."""
    rng = random.Random(6)
    text = "".join(rng.choice("abcd") for _ in range(900))
    frame = []
    for i in range(40):
        changed = list(text)
        for _ in range(rng.randint(0, 3)):
            changed[rng.randint(0, 899)] = "#"
        lo, hi = sorted((rng.randint(0, 336), rng.randint(0, 336)))
        context = "".join(changed)[400 - hi : 400 - lo + suffix_dedup.LENGTH].encode()
        frame.append((1, lo, hi, str(i).encode(), 1 + (i % 7 == 0), context))
    group = pd.DataFrame(frame, columns=["anchor", "lo", "hi", "region", "n", "context"])
    sorted_runs = suffix_dedup._Lot(group, 0).repeated((group["n"] == 1).to_numpy())
    hashed = suffix_dedup._equal_windows(group)
    offsets = lambda runs: sorted({d for a, b in runs for d in range(a, b + 1)})
    assert [offsets(r) for r in sorted_runs] == [offsets(r) for r in hashed]
    assert any(hashed)


def test_suffix_dedup_of_long_texts_and_small_lots(spark, scratch):
    rng = random.Random(9)
    body = "".join(rng.choice("abcdefgh") for _ in range(700_000))
    docs = [(1, body), (2, "#" + body[100_000:100_500] + "#" + body[262_000:262_700] + "#")]
    assert suffix_rows(spark, scratch, docs) == [
        (1, 700_000, 1200, 2, hashlib.sha256((body[:100_000] + body[100_500:262_000] + body[262_700:]).encode()).hexdigest()),
        (2, 1203, 1200, 2, hashlib.sha256(b"###").hexdigest()),
    ]


def test_suffix_dedup_repeated_rows_and_clashes(spark, scratch):
    text = "".join(random.Random(1).choice("abcd") for _ in range(500))
    docs = frame(spark, [(1, text, 3, "k"), (1, text, 3, "k")], "doc_id long, text string, n_bytes int, key string")
    found = suffix_dedup.remove_repeats(docs, scratch).collect()
    assert [(r.n_bytes, r.n_removed, r.key) for r in found] == [(500, 500, "k")] * 2
    assert suffix_dedup.remove_repeats(docs.limit(0), scratch).count() == 0


def test_windows_that_polynomials_confuse_are_told_apart():
    """Thue-Morse words and their complements have equal polynomials modulo 2**64."""
    bits = [bin(n).count("1") % 2 for n in range(512)]
    one, other = (bytes(97 + (b ^ flip) for b in bits) for flip in (0, 1))
    a, b = (suffix_dedup._window_hashes(x + b"z" * suffix_dedup.LENGTH, 0, 512) for x in (one, other))
    differ = (a[0] != b[0]) & (a[1] != b[1])
    assert differ[:512].all() and not differ[512]
