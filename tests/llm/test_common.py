"""Samples by hash limits, and lots of texts."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import common
from tillroll.llm.common import hash_sample, lots


@pytest.mark.parametrize("cell, bits", [(1 << 14, 12), (4, 12), (4, 3), (1, 1)])
def test_the_smallest_hashes_of_each_group_are_chosen(spark, monkeypatch, cell, bits):
    monkeypatch.setattr(common, "CELL", cell)
    monkeypatch.setattr(common, "CELL_BITS", bits if bits > 1 else 2)
    rng = np.random.default_rng(21)
    rows = [(str(g), int(x)) for g, n in (("a", 300), ("b", 40), ("c", 3)) for x in rng.integers(0, 250, n)]
    frame = spark.createDataFrame(rows, "g string, x long")
    hashes = {r["x"]: r["h"] for r in frame.select("x", F.xxhash64("x").alias("h")).distinct().collect()}
    groups = defaultdict(set)
    for g, x in rows:
        groups[g].add(x)
    for size in (1, 5, 39):
        wanted = {(g, x) for g, own in groups.items() for x in sorted(own, key=hashes.get)[:size]}
        found = [tuple(r) for r in hash_sample(frame, F.xxhash64("x"), ["g"], size, 3).collect()]
        assert len(found) == len(set(found)) and set(found) == wanted
        assert {r["g"] for r in hash_sample(frame, F.xxhash64("x"), ["g"], size, 1).collect()} == {"a"}
    every = sorted({x for _, x in rows}, key=hashes.get)
    for size in (7, 10_000):
        assert {r["x"] for r in hash_sample(frame, F.xxhash64("x"), [], size, 1).collect()} == set(every[:size])
    assert hash_sample(frame.limit(0), F.xxhash64("x"), ["g"], 5, 3).count() == 0


def test_lots_hold_every_text_once():
    texts = [b"x" * n for n in (5, 1, 0, 9, 3, 3, 3, 20, 0)]
    found = list(lots(texts, 6))
    assert [n for first, last in found for n in range(first, last)] == list(range(len(texts)))
    assert all(last - first == 1 or sum(map(len, texts[first:last])) <= 6 for first, last in found)
    assert list(lots([], 6)) == []
