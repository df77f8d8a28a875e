"""Fingerprints and their components against comparing all pairs."""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tillroll.llm import simhash
from tillroll.llm.simhash import fingerprint, links, near_prints, simhash_query, spanning

SF = "/root/testdata/sf0.01"


def plain_print(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, bits=2):
    """Smallest id reachable, by comparing every fingerprint with all others."""
    own = np.array(prints, np.uint64)
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(own)):
        for j in np.flatnonzero(np.bitwise_count(own ^ own[i]) <= bits):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, name in enumerate(ids):
        if name is not None:
            least[find(i)] = min(name, least.get(find(i), name))
    return [least.get(find(i)) for i in range(len(ids))]


def test_query_equals_all_pairs(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = {r["doc_id"]: r for r in simhash_query(spark, SF).collect()}
    prints = {k: plain_print(t) for k, t in docs.items()}
    assert {k: r["fingerprint"] for k, r in found.items()} == {k: f"{p:016x}" for k, p in prints.items()}
    ids = list(docs)
    assert [found[i]["component_id"] for i in ids] == plain_components(ids, [prints[i] for i in ids])


def close_prints(rng, groups, members):
    """Fingerprints in clusters: each a few flipped bits away from an earlier one."""
    out = []
    for _ in range(groups):
        cluster = [int(rng.integers(0, 2**64, dtype=np.uint64))]
        for _ in range(members - 1):
            near = cluster[int(rng.integers(len(cluster)))]
            for bit in rng.choice(64, int(rng.integers(0, 5)), replace=False):
                near ^= 1 << int(bit)
            cluster.append(near)
        out += cluster
    return out


def check_links(spark, scratch, prints, bits):
    frame = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in sorted(set(prints))], "fingerprint long")
    edges = [(np.int64(r["u"]).view(np.uint64), np.int64(r["v"]).view(np.uint64)) for r in links(frame, scratch, bits).collect()]
    own = sorted(set(prints))
    at = {p: i for i, p in enumerate(own)}
    parent = list(range(len(own)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for u, v in edges:
        a, b = find(at[int(u)]), find(at[int(v)])
        parent[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(own))] == plain_components(list(range(len(own))), own, bits)


def test_no_link_is_lost(spark, scratch):
    prints = close_prints(np.random.default_rng(3), 60, 40)
    for bits in (0, 2, 3):
        check_links(spark, scratch, prints, bits)


def test_hot_anchors_are_compared_in_tiles(spark, scratch, monkeypatch):
    monkeypatch.setattr(simhash, "HOME_TILE", 8)
    monkeypatch.setattr(simhash, "VISITOR_TILE", 16)
    check_links(spark, scratch, close_prints(np.random.default_rng(4), 3, 300), 2)


def test_large_tiles(spark, scratch, monkeypatch):
    monkeypatch.setattr(simhash, "AT_ONCE", 256)
    check_links(spark, scratch, close_prints(np.random.default_rng(5), 2, 200), 2)


def test_every_anchor_in_reach_is_listed():
    rng = np.random.default_rng(6)
    prints = rng.integers(0, 2**64, 500, dtype=np.uint64)
    for bits in (1, 2):
        flipped = prints.copy()
        for k in range(len(flipped)):
            for bit in rng.choice(64, bits, replace=False):
                flipped[k] ^= np.uint64(1) << np.uint64(bit)
        homes, listed = simhash._homes(prints), [{int(h)} for h in simhash._homes(flipped)]
        for who, anchors in simhash._visits(flipped, 2):
            for w, anchor in zip(who.tolist(), anchors.tolist(), strict=True):
                assert anchor not in listed[w]
                listed[w].add(anchor)
        assert all(int(h) in seen for h, seen in zip(homes, listed, strict=True))


def test_edges(spark, scratch):
    rows = [
        (5, None, "x"), (4, "", "x"), (9, "  \t\n", "y"),  # no words: zero, linked with each other
        (7, "One two", "z"), (3, "one  TWO", None), (3, "one  TWO", None),
        (None, "one two", "n"), (None, "a text nobody else has", "n"), (8, "É É é", "n"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    found = sorted((tuple(r) for r in near_prints(docs, scratch).collect()), key=repr)
    ids, prints = [r[0] for r in rows], [plain_print(r[1]) for r in rows]
    wanted = zip(ids, [int(np.uint64(p).view(np.int64)) for p in prints], plain_components(ids, prints), strict=True)
    assert found == sorted(wanted, key=repr)
    assert near_prints(docs.limit(0), scratch).count() == 0
    hashes = spark.createDataFrame([("one two",)], "t string").select(F.xxhash64("t")).first()[0]
    assert np.int64(hashes).view(np.uint64) == fingerprint(b"One two")


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = " ".join(f"w{n % 97}" for n in range(3000)) + " " + "z" * 500
    whole = fingerprint(text.encode())
    assert whole == plain_print(text)
    monkeypatch.setattr(simhash, "PIECE_BYTES", 1)
    assert fingerprint(text.encode()) == whole
    for short in ("a", "a b", "a b c", "a b c d"):
        assert fingerprint(short.encode()) == plain_print(short)


def test_spanning():
    u, v = spanning(np.array([5, 7, 1, 2]), np.array([7, 9, 2, 2]))
    assert sorted(zip(u.tolist(), v.tolist(), strict=True)) == [(1, 2), (5, 7), (5, 9)]
    assert [x.tolist() for x in spanning(np.zeros(0, int), np.zeros(0, int))] == [[], []]
