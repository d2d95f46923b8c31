"""SimHash near-duplicates with vantage-point trees.

Fingerprints: A-Z lower-cased, words split at ASCII white space, shingles of
k words (repeats count; fewer words: the whole sequence; none: fingerprint
zero), XXH64 with seed 42 of each; a bit is set if it is set in over half
the hashes.  A null text counts as empty.

Pairs: documents with one fingerprint form a class, so copies never meet as
pairs.  The distinct fingerprints are the nodes of a vantage-point tree over
Hamming distance.  Its upper levels deal them out: vantage point j has shells
(ranges of distance), a fingerprint's shells name its home shard, and by the
triangle inequality all its partners within ``radius`` lie in shards whose
shells overlap [d - radius, d + radius]; it is sent there as a query (only
to shards not before its own: a pair needs to meet once).  In a shard the
lower levels prune in the same way by exact distances to further vantage
points, down to tiles in which every remaining pair is compared.  A shard
returns a spanning forest of its links, not the links, so a group of
near-copies of any size costs one row per member.

Vantage points and shells are fitted on a bounded sample of fingerprints
(``SAMPLE``); they steer only how evenly work is dealt, never which pairs
are found.  Random 64-bit fingerprints have distances that crowd round 32,
so the bounds prune a constant share per level: the number of comparisons
stays a fraction of all pairs of distinct fingerprints.

Components are labelled with the smallest doc_id in them (null ids are
passed over; a component without any other id has a null label).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import store
from ticklake.llm.components import star_forest

SEED = 42
CHUNK = 65_536              # hashes whose bits are counted at once
SAMPLE = 2_048              # fingerprints that vantage points are chosen by
SHELLS = 8                  # shells of an upper level
SHARD_NODES = 200_000       # fingerprints of a shard, about
SHARD_QUERIES = 1_000_000   # queries that one task of a shard gets, about
MIN_SALTS = 4               # tasks of a shard, at least
INNER_LEVELS = 3
TILE = 1 << 20              # comparisons held at once


def simhash(text: bytes | None, k: int) -> int:
    words = (text or b"").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= k:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
    ends = ends[k - 1:].tolist()
    n, ones = len(ends), np.zeros(64, np.int64)
    for lo in range(0, n, CHUNK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[lo:lo + CHUNK], ends[lo:lo + CHUNK])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([simhash(t.as_py(), shingle) for t in b.column(1)], dtype=np.uint64)
            yield pa.record_batch([b.column(0), pa.array(fps.view(np.int64), pa.int64())], names=["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def distance(a: np.ndarray, v: int) -> np.ndarray:
    return np.bitwise_count(a ^ np.uint64(v))


def vantage_points(sample: np.ndarray, n: int) -> list[int]:
    """The sampled fingerprints whose distances to the sample spread most,
    taking each next one for the spread it adds to those before."""
    chosen: list[int] = []
    seen = np.zeros((0, len(sample)))
    pool = sample[:256]
    d = np.stack([distance(sample, int(v)) for v in pool]).astype(float)
    for _ in range(n):
        spread = d.var(axis=1)
        for row in seen:
            c = np.abs(((d - d.mean(axis=1, keepdims=True)) * (row - row.mean())).mean(axis=1))
            spread = spread - c
        best = int(np.argmax(spread))
        chosen.append(int(pool[best]))
        seen = np.vstack([seen, d[best]])
        d[best] = 0
    return chosen


class Forest:
    """Union-find over positions, linking arrays of pairs at once."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, i: np.ndarray) -> np.ndarray:
        r = self.parent[i]
        while True:
            up = self.parent[r]
            if np.array_equal(up, r):
                return r
            r = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.parent, np.maximum(ra, rb), np.minimum(ra, rb))

    def flatten(self) -> np.ndarray:
        self.parent = self.roots(np.arange(len(self.parent)))
        return self.parent


def link_shard(nodes: np.ndarray, queries: np.ndarray, points: np.ndarray, vantage: list[int], radius: int) -> Forest:
    """Links between nodes[queries] and nodes[points] within the radius."""
    forest = Forest(len(nodes))
    dist = [distance(nodes, v).astype(np.int16) for v in vantage]

    def tile(q: np.ndarray, p: np.ndarray) -> None:
        step = max(1, TILE // len(p))
        for lo in range(0, len(q), step):
            part = q[lo:lo + step]
            near = np.bitwise_count(nodes[part][:, None] ^ nodes[p][None, :]) <= radius
            if np.count_nonzero(near) > 4 * (len(part) + len(p)):      # a dense group: skip what is linked
                near &= forest.roots(part)[:, None] != forest.roots(p)[None, :]
            i, j = np.nonzero(near)
            forest.link(part[i], p[j])

    def descend(q: np.ndarray, p: np.ndarray, level: int) -> None:
        if not len(q) or not len(p):
            return
        if level == len(vantage) or len(q) * len(p) <= TILE:
            for lo in range(0, len(p), TILE >> 4):
                tile(q, p[lo:lo + (TILE >> 4)])
            return
        dq, dp = dist[level][q], dist[level][p]
        for s in np.unique(dp):
            descend(q[np.abs(dq - s) <= radius], p[dp == s], level + 1)

    descend(queries, points, 0)
    return forest


def near_links(nodes: DataFrame, radius: int) -> DataFrame:
    """Distinct fingerprints (fp long) -> spanning links (u, v)."""
    n = nodes.count()
    if not n:
        return nodes.select(F.col("fp").alias("u"), F.col("fp").alias("v"))
    sample = np.array([r[0] for r in nodes.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()],
                      dtype=np.int64).view(np.uint64)
    levels = max(1, math.ceil(math.log(max(1.0, n / SHARD_NODES), SHELLS)))
    points = vantage_points(sample, min(levels + INNER_LEVELS, len(sample[:256])))
    upper, inner = points[:levels], points[levels:]
    edges = [sorted(set(np.quantile(distance(sample, v), np.arange(1, SHELLS) / SHELLS, method="nearest").tolist()))
             for v in upper]                               # shell i holds edges[i-1] <= d < edges[i]

    def shell(d, bounds):
        return sum(((d >= F.lit(int(b))).cast("long") for b in bounds), F.lit(0).cast("long"))

    lists, home = [], []
    for v, bounds in zip(upper, edges, strict=True):
        d = F.bit_count(F.col("fp").bitwiseXOR(F.lit(v - (1 << 64) if v >> 63 else v)))
        home.append(shell(d, bounds))
        lists.append(F.sequence(shell(d - radius, bounds), shell(d + radius, bounds)))
    width = SHELLS + 1
    code, shards = F.lit(0).cast("long"), F.array(F.lit(0).cast("long"))

    def extend(prefixes, reach):
        return F.flatten(F.transform(prefixes, lambda c: F.transform(reach, lambda s: c * width + s)))

    for h, reach in zip(home, lists, strict=True):
        code, shards = code * width + h, extend(shards, reach)
    share = 0.6 ** levels
    salts = max(MIN_SALTS, math.ceil(n * share / SHARD_QUERIES))
    salt = F.pmod(F.xxhash64("fp"), F.lit(salts))
    coded = nodes.select("fp", code.alias("home"), shards.alias("reach"))
    as_point = coded.select("fp", F.col("home").alias("shard"),
                            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"),
                            F.lit(True).alias("point"))
    as_query = coded.select("fp", F.explode(F.filter("reach", lambda s: s >= F.col("home"))).alias("shard"),
                            salt.alias("salt"), F.lit(False).alias("point"))

    def run(table: pa.Table) -> pa.Table:
        fp = table["fp"].to_numpy().view(np.uint64)
        is_point = table["point"].to_numpy(zero_copy_only=False)
        both, where = np.unique(fp, return_inverse=True)
        forest = link_shard(both, where[~is_point], where[is_point], inner, radius)
        root = forest.flatten()
        child = np.flatnonzero(root != np.arange(len(both)))
        signed = both.view(np.int64)
        return pa.table({"u": pa.array(signed[child], pa.int64()), "v": pa.array(signed[root[child]], pa.int64())})

    return as_point.union(as_query).groupBy("shard", "salt").applyInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int, radius: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, fp, fingerprint (hex), component_id: one row per document."""
    fps = store(fingerprints(docs, shingle, id_col, text_col), "simhash")
    nodes = store(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    stars = star_forest(near_links(nodes.select("fp"), radius))
    rooted = (nodes.join(stars.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    label = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = rooted.join(label, "root").select("fp", "component_id")
    return fps.join(labels, "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int, radius: int, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The documents whose id labels their component (repeated rows of such
    an id: one of them).  Documents without an id all stay: nothing names
    the one to keep."""
    groups = near_duplicates(docs, shingle, radius, id_col, text_col)
    lead = groups.where("doc_id = component_id").select(F.col("doc_id").alias(id_col)).distinct()
    named = docs.join(lead, id_col, "left_semi").dropDuplicates([id_col])
    return named.select(docs.columns).union(docs.where(F.col(id_col).isNull()))
