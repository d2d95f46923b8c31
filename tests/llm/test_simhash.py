"""Fingerprints, near pairs and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from ticklake.llm import simhash as sh
from ticklake.llm.components import star_forest

SCHEMA = "doc_id long, text string, fp string"


def plain_fingerprint(text, k):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(fps))]


def texts(seed=1, n=120):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    out = [None, "", " \t\n", "One", "ONE  two\tthree", "one two three", "É x", "é x", "word " * 5000]
    while len(out) < n:
        t = [rng.choice(vocab) for _ in range(rng.randint(1, 120))]
        out.append(" ".join(t))
        for _ in range(rng.randint(0, 3)):
            t = list(t)
            t[rng.randrange(len(t))] = rng.choice(vocab)
            out.append(" \n".join(t))
    return out


def test_fingerprints_and_components(frame):
    rows = [(i * 3 + 1, t, "clash") for i, t in enumerate(texts())]
    got = {r["doc_id"]: r for r in sh.near_duplicates(frame(rows, SCHEMA), 4, 4).collect()}
    fps = [plain_fingerprint(t, 4) for _, t, _ in rows]
    roots = brute_components(fps, 4)
    assert len(got) == len(rows)
    for (i, _, _), f, r in zip(rows, fps, roots, strict=True):
        assert got[i]["fingerprint"] == f"{f:016x}"
        assert got[i]["component_id"] == rows[r][0]


@pytest.mark.parametrize(("shard", "levels"), [(40, 1), (5, 2)])
def test_sharding_loses_no_pair(spark, monkeypatch, shard, levels):
    monkeypatch.setattr(sh, "SHARD_NODES", shard)
    monkeypatch.setattr(sh, "SHARD_QUERIES", 20)
    monkeypatch.setattr(sh, "TILE", 16)
    rng = np.random.default_rng(levels)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(x) for x in rng.choice(64, rng.integers(0, 6), replace=False))
            for b in base for _ in range(5)]
    fps = sorted({*map(int, base), *near, 0, 2**64 - 1})
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    links = sh.near_links(spark.createDataFrame([(f,) for f in signed], "fp long"), 4)
    stars = {r["u"]: r["v"] for r in star_forest(links).collect()}
    roots = brute_components(fps, 4)
    groups = {}
    for f, r in zip(signed, roots, strict=True):
        groups.setdefault(r, set()).add(stars.get(f, f))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_dense_group_returns_a_forest():
    nodes = np.unique(np.array([sum(1 << b for b in s) for s in
                                [(i, j) for i in range(20) for j in range(i)]], dtype=np.uint64))
    forest = sh.link_shard(nodes, np.arange(len(nodes)), np.arange(len(nodes)), [0], 4)
    assert (forest.flatten() == 0).all()


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (7, 7)], "u long, v long")
    got = {r["u"]: r["v"] for r in star_forest(links).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100: 99}
    assert star_forest(links.limit(0)).count() == 0


def test_empty_null_and_repeated(frame):
    assert sh.near_duplicates(frame([], SCHEMA), 4, 4).count() == 0
    rows = [(None, "a b c d e", ""), (5, "a b c d e", ""), (5, "a b c d e", ""), (None, "other words here now", ""), (9, None, "")]
    got = sorted(((r["doc_id"], r["component_id"]) for r in sh.near_duplicates(frame(rows, SCHEMA), 4, 4).collect()),
                 key=str)
    assert got == [(5, 5), (5, 5), (9, 9), (None, 5), (None, None)]
    kept = sh.keep_first(frame(rows, SCHEMA), 4, 4)
    assert kept.columns == ["doc_id", "text", "fp"]
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [5, 9, None, None]
