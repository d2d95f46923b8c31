"""The trie against a dictionary of prefixes, in one shard and in many."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ticklake.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, ids string, words long"


def words(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text))


def turns(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(ts)] for c, ts in convs.items()}


def plain(seqs):
    nodes = {}
    for c, ts in sorted(seqs.items()):
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    kids, leaves, saved = {}, {}, {}
    for p, members in nodes.items():
        leaf = not any(len(seqs[c]) > len(p) for c in members)
        for d in range(len(p) + 1):
            leaves[p[:d]] = leaves.get(p[:d], 0) + leaf
            saved[p[:d]] = saved.get(p[:d], 0) + (len(members) - 1) * (words(p[-1][1]) if p else 0)
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    return sorted(((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), kids.get(p, 0), leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c in m if len(seqs[c]) == len(p)).encode()).hexdigest())
                   for p, m in nodes.items()), key=str)


def got(frame, rows, **kw):
    df = frame([(*r, "x", 1) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in trie.prefix_trie(trie.sequences(df), **kw).select(*trie.OUT).collect()), key=str)


def random_rows(rng, n):
    rows = []
    for c in range(n):
        k = rng.choice([1, 1, 2, 3, 5]) if c else 40
        path = [rng.choice(["a", "b b", "c d e"]) if rng.random() < 0.4 else "same same" for _ in range(k)]
        rows += [(c * 3 - 7, t, rng.choice(["user", None]) if t > 3 else "user", x) for t, x in enumerate(path)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_turns", [7, 40, 100_000])
def test_random(frame, shard_turns):
    rows = random_rows(random.Random(shard_turns), 120)
    assert got(frame, rows, shard_turns=shard_turns) == plain(turns(rows))


def test_one_conversation_many_times(frame):
    rows = [(c, t, "user", x) for c in range(60) for t, x in enumerate(["hello there", "", "end"])]
    rows += [(100, 0, "user", "hello there"), (101, 0, "user", "zzz"), (102, None, None, None)]
    rows += [(103, t, "user", x) for t, x in enumerate(["hello there", "", "end", "on and on"])]
    assert got(frame, rows, shard_turns=20) == plain(turns(rows))


def test_edge_cases(frame):
    rows = [(1, 0, "u", "a"), (1, 0, "u", "a"), (1, 0, "A", "b"), (2, None, None, None), (2, 5, "u", "a b  c"),
            (3, 0, "u", "a"), (None, 0, "u", "a")]
    assert got(frame, rows) == plain({c: t for c, t in turns(rows).items() if c is not None})
    assert got(frame, []) == []
    assert got(frame, [(5, 0, "u", "w " * 50_000)]) == plain({5: [("u", "w " * 50_000)]})


@pytest.mark.parametrize("shard_turns", [30, 100_000])
def test_heads(frame, shard_turns):
    rows = random_rows(random.Random(5), 90)
    df = frame([(*r, "x", 1) for r in rows], SCHEMA)
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % 4).cast("int")
    made = trie.prefix_trie(trie.with_heads(trie.sequences(df), h, c - c % 20, longest=3), shard_turns=shard_turns)
    own = turns(rows)
    seqs = {}
    for conv, ts in own.items():
        k = zlib.crc32(str(conv).encode()) % 4
        seqs[conv] = own.get(conv - int(__import__("math").fmod(conv, 20)), [])[:k] + ts[k:]
    assert sorted((tuple(r) for r in made.select(*trie.OUT).collect()), key=str) == plain(seqs)
