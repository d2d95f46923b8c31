"""Language-model scores against a plain count of everything."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from ticklake.llm import interpolation as lm

SCHEMA = "doc_id long, text string, score string"


def corpus(n=150):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(40)] + ["É", "The", "the"]
    out = [(1000, None, ""), (None, "w1 w2", ""), (1001, "", ""), (1002, " \t", ""), (1003, "new words only", ""),
           (1004, "w1 " * 3000, ""), (7, "w1 w2", ""), (7, "w1 w2", "")]
    for i in range(n):
        a = rng.randrange(40)
        t = []
        for _ in range(rng.randint(1, 40)):
            a = (a + rng.choice([1, 1, 1, 5])) % 43
            t.append(vocab[a])
        out.append((i + 10, " ".join(t), ""))
    return out


def words(t):
    return (t or "").encode().lower().split() + [None]


def remainder(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7


@pytest.mark.parametrize("block", [200, 10**6])
def test_against_plain_counts(frame, monkeypatch, block):
    monkeypatch.setattr(lm, "BLOCK_TOKENS", block)
    monkeypatch.setattr(lm, "BUCKET_KEYS", 500)
    rows = corpus()
    got = sorted(lm.score(frame(rows, SCHEMA).repartition(3), ).collect(), key=str)
    train = [words(t) for i, t, _ in rows if remainder(i) != 2]
    c1 = Counter(w for t in train for w in t)
    n, v = sum(c1.values()), len(c1)
    want = []
    for i, t, _ in rows:
        ws = words(t)
        base = sum(math.log10((c1[w] + 1) / (n + v + 1)) for w in ws)
        want.append((i, remainder(i) == 2, len(ws), sum(c1[w] > 0 for w in ws), n, base))
    assert len(got) == len(rows)
    for g, w in zip(got, sorted(want, key=str), strict=True):
        assert tuple(g)[:5] == w[:5] and abs(g["base_score"] - w[5]) < 1e-9 * max(1, abs(w[5]))
    held = [g for g in got if g["held_out"]]
    assert sum(g["score"] for g in held) > sum(g["base_score"] for g in held)


def test_model_is_the_mixture_and_sums_to_one(frame, monkeypatch):
    """Scores equal the formula with the learned weights; over all words and
    the unknown one a context's probabilities add up to 1."""
    kept = {}
    plain = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda *a: kept.setdefault("w", plain(*a)))
    rows = corpus()
    got = {r["doc_id"]: r["score"] for r in lm.score(frame(rows, SCHEMA)).collect()}
    weights = kept["w"]
    train = [words(t) for i, t, _ in rows if remainder(i) != 2]
    c1 = Counter(w for t in train for w in t)
    c2 = Counter(p for t in train for p in zip(["^", *t], t))
    n, v = sum(c1.values()), len(c1)

    def prob(a, w):
        c = len(train) if a == "^" else c1[a]
        k = weights[c.bit_length()]
        return k[0] * (c2[a, w] / c if c else 0) + k[1] * c1[w] / n + k[2] / (v + 1)

    for i, t, _ in rows[:60]:
        ws = words(t)
        want = sum(math.log10(prob(a, w)) for a, w in zip(["^", *ws], ws))
        assert got[i] == pytest.approx(want, rel=1e-9)
    assert np.allclose(weights.sum(axis=1), 1)
    for a in ("^", b"w3", b"the"):
        assert sum(prob(a, w) for w in [*c1, "unknown"]) == pytest.approx(1, rel=1e-6)


def test_empty_table(frame):
    assert lm.score(frame([], SCHEMA)).count() == 0
    one = lm.score(frame([(None, None, "")], SCHEMA)).collect()
    assert len(one) == 1 and one[0]["n_tokens"] == 1
