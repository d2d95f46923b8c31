"""Exact top-k (bit slices) and the block join against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticklake.llm import bitslice, blockjoin

SCHEMA = "vec_id long, embedding array<float>, query_id string"


def rows(seed=0, n=300, dim=16):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 0.3, (n, dim)).astype(np.float32)
    x[n // 2:n // 2 + 40] = x[3]                    # ties
    x[7] = 0.0
    out = [(i, [float(v) for v in x[i]], "clash") for i in range(n)]
    out += [(1000, None, None), (1001, [0.1] * (dim - 1) + [None], "a"), (1002, [float("nan")] * dim, "b"),
            (1003, [float("inf")] * dim, "c"), (None, [0.5] * dim, "d"), (1040, [0.25] * 3, "e"),
            (1060, [], "f")]
    return out


def good(data):
    return [(i, v) for i, v, _ in data if i is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]


def brute_ip(data, step, k):
    data = good(data)
    q = {i: [math.floor(64.0 * float(np.float32(x))) for x in v] for i, v in data}
    out = []
    for a in q:
        if a % step == 0:
            s = sorted((-sum(x * y for x, y in zip(q[a], q[b])), b) for b in q if b != a and len(q[a]) == len(q[b]))
            out += [(a, r, b, -m) for r, (m, b) in enumerate(s[:k], 1)]
    return sorted(out)


def brute_l2(data, step, k):
    data = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in good(data) if any(v)]
    out = []
    for a, x in data:
        if a % step == 0:
            s = sorted((float(np.sqrt(((y - x) ** 2).sum())), b) for b, y in data if b != a and len(x) == len(y))
            out += [(a, r, b, d) for r, (d, b) in enumerate(s[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize(("k", "per_block"), [(20, 64), (5, 1000), (1000, 100)])
def test_bitsliced_topk_equals_brute_force(frame, k, per_block):
    data = rows()
    got = bitslice.search(frame(data, SCHEMA), "vec_id", "embedding", F.col("vec_id") % 20 == 0, k,
                          rows_per_block=per_block, queries_per_block=7)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute_ip(data, 20, k)


@pytest.mark.parametrize(("k", "per_block"), [(10, 50), (3, 1000), (1000, 100)])
def test_block_join_equals_brute_force(frame, k, per_block):
    data = rows(1)
    got = sorted(map(tuple, blockjoin.search(frame(data, SCHEMA), "vec_id", "embedding", F.col("vec_id") % 20 == 0,
                                             k, rows_per_block=per_block, queries_per_block=7).collect()))
    want = brute_l2(data, 20, k)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-14)


def test_large_components(frame):
    rng = np.random.default_rng(5)
    data = [(i, [float(np.float32(v)) for v in rng.normal(0, 5000, 8)], "") for i in range(60)]
    got = bitslice.search(frame(data, SCHEMA), "vec_id", "embedding", F.col("vec_id") % 20 == 0, 4)
    assert sorted(map(tuple, got.collect())) == brute_ip(data, 20, 4)


def test_empty_and_repeated_rows(frame):
    none = frame([], SCHEMA)
    for op in (bitslice, blockjoin):
        assert op.search(none, "vec_id", "embedding", F.col("vec_id") % 20 == 0, 5).count() == 0
    data = [(0, [0.5, 0.5], ""), (0, [0.5, 0.5], ""), (1, [0.5, 0.25], ""), (1, [0.5, 0.25], "")]
    got = bitslice.search(frame(data, SCHEMA), "vec_id", "embedding", F.col("vec_id") % 20 == 0, 5).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 1536), (0, 2, 1, 1536)]
    got = blockjoin.search(frame(data, SCHEMA), "vec_id", "embedding", F.col("vec_id") % 20 == 0, 5).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 0.25), (0, 2, 1, 0.25)]


def test_large_and_tiny_components(frame):
    """Components near the ends of a double: no crash, no candidate lost."""
    big = [(i, [s * (1 + i / 7), 1.0 - i, 0.5], "x") for i, s in enumerate([1e200, -1e200, 1e300, 1e-200, -1e-300, 1e20, 3.0])]
    df = frame([(i + 20 * (i == 0), v, c) for i, v, c in big], "vec_id long, embedding array<double>, query_id string")
    data = {r.vec_id: r.embedding for r in df.collect()}
    got = {(r.query_id, r.vec_id): r.score for r in blockjoin.search(df, "vec_id", "embedding", F.col("vec_id") > -1, k=10).collect()}
    assert set(got) == {(a, b) for a in data for b in data if a != b}
    for (a, b), d in got.items():
        assert d == pytest.approx(math.hypot(*(x / 4 - y / 4 for x, y in zip(data[a], data[b]))) * 4, rel=1e-12)
    hits = bitslice.search(df, "vec_id", "embedding", F.col("vec_id") == 20, k=20).collect()
    def q(x):
        return math.floor(max(-2.0 ** 62, min(2.0 ** 62, 64.0 * x)))
    want = {b: max(-2 ** 63, min(2 ** 63 - 1, sum(q(x) * q(y) for x, y in zip(data[20], data[b])))) for b in data if b != 20}
    assert {r.vec_id: r.score for r in hits} == want
    tiny = frame([(i, [1e-200 * i, 2e-200], "x") for i in range(1, 30)], "vec_id long, embedding array<double>, query_id string")
    near = blockjoin.search(tiny, "vec_id", "embedding", F.col("vec_id") == 5, k=2).collect()
    assert [(r.vec_id, r.score) for r in sorted(near, key=lambda r: r.rank)] == [
        (4, pytest.approx(1e-200)), (6, pytest.approx(1e-200))]
