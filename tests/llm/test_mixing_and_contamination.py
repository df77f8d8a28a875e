"""Decontamination and mixing against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tillroll.llm import decontaminate, mixing

FOLDER = "/root/testdata/sf0.001"


# -- decontamination ---------------------------------------------------------------------------


def fold(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    out = []
    for doc, text in docs:
        words, hit, found = fold(text), set(), []
        for item, passage in items:
            own, occurs = fold(passage), False
            size = min(window, len(own))
            for i in range(len(own) - size + 1) if own else ():
                for k in range(len(words) - size + 1):
                    if words[k : k + size] == own[i : i + size]:
                        hit.update(range(k, k + size))
                        occurs = True
            if occurs:
                found.append("" if item is None else str(item))
        out.append((doc, len(words), len(hit), len(found), sorted(found)))
    return sorted(out, key=repr)


def found(spark, scratch, docs, items, **settings):
    got = decontaminate.find_contamination(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        scratch,
        **settings,
    )
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r["items"]) for r in got.collect()), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "é1", "c", "d9"])
    items = [(i, " ".join(word() for _ in range(rng.choice([12, 15, 25])))) for i in range(6)]
    items += [(10, "short item only"), (11, "Short, ITEM only"), (None, items[0][1]), (12, None), (13, "!?"), (14, "é1 é1 é1 é1")]
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 200)))) for i in range(10)]
    for i, (_, text) in enumerate(items[:6]):
        words = text.split()
        docs.append((100 + i, "x " + "--".join(words[: rng.randint(8, len(words))]).upper() + " y. SHORT item, only"))
    return docs + [(200, None), (201, ""), (None, items[1][1]), (3, items[2][1] + " " + items[2][1])], items


@pytest.mark.parametrize("block_words", [50_000, 20])
def test_contamination_equals_brute_force(spark, scratch, block_words):
    docs, items = corpus(block_words)
    assert found(spark, scratch, docs, items, block_words=block_words) == brute(docs, items)


def test_contamination_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    windows = {}
    for item, text in items:
        words = fold(text)
        for i in range(max(1, len(words) - 9)):
            windows.setdefault(tuple(words[i : i + 10]), set()).add(item)
    expected = []
    for doc, text in docs:
        words, hit, own = fold(text), set(), set()
        for k in range(len(words) - 9):
            if at := windows.get(tuple(words[k : k + 10])):
                hit.update(range(k, k + 10))
                own |= at
        names = ",".join(sorted(map(str, own)))
        expected.append((doc, len(words), len(hit), len(own), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    got = [tuple(r) for r in decontaminate.decontamination_query(spark, FOLDER).collect()]
    assert sorted(got) == sorted(expected)
    assert any(row[5] for row in got)


def test_cleaned_texts_hold_no_item(spark, scratch):
    item = " ".join(f"q{i}" for i in range(12))
    # Without the inner passage, the outer one closes up.
    inner = " ".join(f"q{i}" for i in range(6)) + " " + item + " " + " ".join(f"q{i}" for i in range(6, 12))
    filler = " ".join(f"z{i}" for i in range(60))
    data = [(1, f"{filler} {inner} {filler}", 5), (2, item, 6), (3, filler, None), (None, None, 7), (4, "", 8)]
    docs = spark.createDataFrame(data, "doc_id long, text string, n_hit int")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = decontaminate.cleaned(docs, items, scratch)
    assert kept.columns == docs.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert set(texts) == {1, 3, 4, None}
    assert texts[1].split() == (filler + " " + filler).split() and texts[3] == filler
    assert decontaminate.cleaned(docs, items.limit(0), scratch).count() == 5
    assert decontaminate.cleaned(docs.limit(0), items, scratch).count() == 0


# -- mixing ------------------------------------------------------------------------------------


def brute_targets(sizes):
    """Targets by sharing again what is above twice a source's size."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [s for s in sizes if s is None]
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        share = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * share > 2 * sizes[s]}
        if not above:
            target |= {s: weight[s] * share for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in above}
        left -= sum(2.0 * sizes[s] for s in above)
        open_ -= above
    return target


def test_mix_meets_its_targets(spark, scratch):
    rng = random.Random(2)
    data = []
    for i in range(600):
        source = rng.choice(["a", "a", "a", "B", "é", "\U0001f600", "", None, "z"])
        data.append((i, " \t".join(["w"] * rng.choice([0, 1, 5, 30, 200])), source, i))
    data += [(1000, None, "empty", 1), (None, "x y z", "a", 2), (None, "x y z", "a", 2), (1001, " ", None, 3)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, size int")
    got = [r.asDict() for r in mixing.mix(docs, scratch).collect()]
    again = mixing.mix(docs.repartition(3), scratch)
    assert sorted((repr(r.doc_id), r.source or "", r.taken) for r in again.collect()) == sorted(
        (repr(r["doc_id"]), r["source"] or "", r["taken"]) for r in got
    )
    sizes = {}
    for r in data:
        sizes[r[2]] = sizes.get(r[2], 0) + len((r[1] or "").split())
    expected = brute_targets(sizes)
    for source, target in expected.items():
        own = [r for r in got if r["source"] == source]
        assert all(r["source_size"] == sizes[source] and abs(r["target"] - target) < 1e-6 for r in own)
        taken = sum(r["taken"] for r in own)
        assert taken <= target + 1e-6 and target - taken <= max(1, 0.02 * target)
    assert all(r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in got)
    assert len(got) == len(data)


def test_mix_edges(spark, scratch):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema), scratch).count() == 0
    blank = mixing.mix(spark.createDataFrame([(1, None, None), (2, "", "a")], schema), scratch).collect()
    assert [(r.taken, r.target) for r in blank] == [(0, 0.0)] * 2
    alone = mixing.mix(spark.createDataFrame([(i, "a b", "s") for i in range(40)], schema), scratch)
    assert alone.agg(F.sum("taken")).first()[0] == 120
