"""Approximate nearest neighbours by a block matrix join.

Rows and queries are cut into blocks; each (query block, row block) pair is
one tile.  A vector x is held as int8 codes c with a scale s and the exact
norm e of what quantising lost: |x - s*c| = e.  A tile's product of codes
gives the distance of the quantised vectors, which differs from the true
one by at most e_x + e_y.  A row whose lower bound exceeds the k-th smallest
upper bound of the tile cannot be among the query's k nearest; the surviving
pairs are recomputed from the original components in double precision and
kept in a heap of k per query.  A last merge takes the k best of a query's
heaps, so the result is exact (recall 1) as long as the bounds hold, which
they do in double precision up to a margin that is added to them.

Vectors that are null, all zero, empty, or hold a null or non-finite
component take no part; vectors of another length than the query's are no
candidates; neither are rows with the query's own id.  Fewer than k
candidates: all of them.  Ties go to the smaller id.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import blocks_for, store, valid_vector

ROWS_PER_BLOCK = 16_384
QUERIES_PER_BLOCK = 256
TILE_CELLS = 2_000_000      # distances held at once
LEAST, MOST = 1e-140, 1e140  # magnitudes whose squares a double holds well

BLOCK_SCHEMA = "blk long, dim int, ids binary, vectors binary, codes binary, scales binary, errors binary"
HIT_SCHEMA = "query_id long, qkey long, vec_id long, score double"


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes int8, scale, error norm) of each row of x.  A row whose
    components are too large or too small for their squares gets scale NaN:
    no bound holds for it, so it survives every tile and is computed whole."""
    scale = np.abs(x).max(axis=1) / 127.0
    scale = np.where((scale > LEAST) & (scale < MOST), scale, np.nan)
    usable = np.where(np.isnan(scale), np.inf, scale)
    codes = np.rint(x / usable[:, None]).astype(np.int8)
    lost = x - codes * np.where(np.isnan(scale), 0.0, scale)[:, None]
    with np.errstate(over="ignore"):
        return codes, scale, np.sqrt((lost * lost).sum(axis=1))


def distances(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances; where squares would overflow or vanish, of scaled gaps."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        gap = rows - query
        out = np.sqrt((gap * gap).sum(axis=1))
        odd = np.flatnonzero(~np.isfinite(out) | (out < LEAST))
        if len(odd):
            half = rows[odd] / 2 - query / 2
            size = np.abs(half).max(axis=1)
            unit = half / np.where(size > 0, size, 1.0)[:, None]
            out[odd] = 2 * (size * np.sqrt((unit * unit).sum(axis=1)))
    return out


def pack(rows: DataFrame, n_blocks: int) -> DataFrame:
    """One row per (block, vector length)."""

    def block(table: pa.Table) -> pa.Table:
        dim = int(table["dim"][0].as_py())
        ids = table["vec_id"].to_numpy()
        x = table["x"].combine_chunks().flatten().to_numpy().reshape(len(ids), dim)
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], np.ascontiguousarray(x[order])
        codes, scale, err = quantise(x)
        blobs = {"ids": ids, "vectors": x, "codes": codes, "scales": scale, "errors": err}
        return pa.table({"blk": pa.array([table["blk"][0].as_py()], pa.int64()), "dim": pa.array([dim], pa.int32())}
                        | {k: pa.array([v.tobytes()], pa.binary()) for k, v in blobs.items()})

    return (rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).alias("blk"), F.size("x").alias("dim"),
                        "vec_id", "x")
            .groupBy("blk", "dim").applyInArrow(block, BLOCK_SCHEMA))


def vector_key(x: np.ndarray) -> int:
    """Tells apart query rows that share an id."""
    return int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=8).digest(), "little", signed=True)


def tile_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 codes.  float32 holds every integer up
    to 2**24, so a float product of the codes is exact in slices of 1,024
    dimensions; the slices are added in double."""
    out = None
    for lo in range(0, a.shape[1], 1024):
        part = (a[:, lo:lo + 1024].astype(np.float32) @ b[:, lo:lo + 1024].astype(np.float32).T).astype(np.float64)
        out = part if out is None else out + part
    return out


def survivors(qc, qs, qe, rc, rs, re_, k: int) -> Iterator[np.ndarray]:
    """Per query, the rows of the tile that the bounds leave."""
    prod = tile_product(qc, rc)
    nq = (qc.astype(np.float64) ** 2).sum(axis=1) * qs * qs
    nr = (rc.astype(np.float64) ** 2).sum(axis=1) * rs * rs
    square = nq[:, None] + nr[None, :] - 2.0 * qs[:, None] * rs[None, :] * prod
    slack = 1e-9 * (nq[:, None] + nr[None, :])          # rounding of the three terms
    low = np.sqrt(np.maximum(square - slack, 0.0)) - (qe[:, None] + re_[None, :]) * (1 + 1e-9)
    high = np.sqrt(np.maximum(square + slack, 0.0)) + (qe[:, None] + re_[None, :]) * (1 + 1e-9)
    high = np.where(np.isnan(high), np.inf, high)
    for i in range(len(qc)):
        bound = np.partition(high[i], k - 1)[k - 1] if high.shape[1] > k else np.inf
        yield np.flatnonzero(~(low[i] > bound))          # what has no bound (NaN) stays


def search(vectors: DataFrame, id_col: str, vec_col: str, is_query: Column, k: int,
           rows_per_block: int = ROWS_PER_BLOCK, queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance): each query's k
    nearest rows, nearest first.  ``is_query`` is over ``vec_id``."""
    v = F.col(vec_col)
    rows = store(vectors.where(valid_vector(v) & F.exists(v, lambda x: x != 0))
                 .select(F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("x"))
                 .where("vec_id IS NOT NULL"), "block-rows")
    queries = rows.where(is_query).dropDuplicates(["vec_id", "x"])
    n_rows, n_queries = rows.count(), queries.count()
    n_blk, n_qblk = blocks_for(n_rows, rows_per_block), blocks_for(n_queries, queries_per_block)
    left = pack(queries, n_qblk).withColumnRenamed("blk", "qblk").withColumn(
        "blk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blk - 1).cast("long"))))
    right = pack(rows, n_blk).withColumn(
        "qblk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_qblk - 1).cast("long"))))
    names = ("ids", "vectors", "codes", "scales", "errors")
    kinds = (np.int64, np.float64, np.int8, np.float64, np.float64)
    pairs = (left.select("qblk", "blk", "dim", *[F.col(n).alias(f"q_{n}") for n in names])
             .join(right, ["qblk", "blk", "dim"])
             .repartition(max(1, min(n_blk * n_qblk, 10_000)), "blk", "qblk"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                dim = batch.column("dim")[r].as_py()
                q_ids, qx, qc, qs, qe, ids, x, rc, rs, re_ = (
                    np.frombuffer(batch.column(p + n)[r].as_py(), dtype=t)
                    for p in ("q_", "") for n, t in zip(names, kinds, strict=True))
                qx, qc, x, rc = (a.reshape(-1, dim) for a in (qx, qc, x, rc))
                out: list[tuple] = []
                # the query's own rows are no candidates but count for the bound
                own = int(np.bincount(np.searchsorted(ids, ids)).max())
                step = max(1, TILE_CELLS // len(ids))
                for lo in range(0, len(q_ids), step):
                    part = slice(lo, lo + step)
                    left_over = survivors(qc[part], qs[part], qe[part], rc, rs, re_, k + own)
                    for i, cand in enumerate(left_over, lo):
                        cand = cand[ids[cand] != q_ids[i]]
                        dist = distances(x[cand], qx[i])
                        heap = heapq.nsmallest(k, zip(dist.tolist(), ids[cand].tolist(), strict=True))
                        out += [(int(q_ids[i]), vector_key(qx[i]), v, d) for d, v in heap]
                cols = list(zip(*out, strict=True)) if out else [[], [], [], []]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(
                    cols, (pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)],
                    names=["query_id", "qkey", "vec_id", "score"])

    hits = pairs.mapInArrow(run, HIT_SCHEMA)

    def merge(table: pa.Table) -> pa.Table:
        best = heapq.nsmallest(k, zip(table["score"].to_pylist(), table["vec_id"].to_pylist(), strict=True))
        return pa.table({"query_id": pa.array([table["query_id"][0].as_py()] * len(best), pa.int64()),
                         "rank": pa.array(range(1, len(best) + 1), pa.int32()),
                         "vec_id": pa.array([v for _, v in best], pa.int64()),
                         "score": pa.array([d for d, _ in best], pa.float64())})

    return hits.groupBy("query_id", "qkey").applyInArrow(merge, "query_id long, rank int, vec_id long, score double")
