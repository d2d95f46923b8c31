"""Exact top-k search by inner product over a bit-sliced index.

Every vector component is quantised to an integer (floor(scale * x), in
double).  The index cuts the rows into blocks of a bounded size; in a block
each (dimension, bit) is one bitmap over the block's rows, sorted by id.  A
query's scores are never computed row by row: the slices that its
components' set bits select are added as bitmaps (a column-compression tree
of full adders), which yields the slices of the score.  The k best rows are
then taken from the most significant slice downward; rows that still tie on
every slice at the boundary are resolved by id.  Only selected rows have
their score read back from the slices.

Components are offset to be unsigned, and a negative query component adds
the complemented slices, so that no subtraction is needed; the constant
this adds to every score of the query is taken off at the end.

Scores must fit in a long.  Vectors that are null, or hold a null or
non-finite component, take no part; vectors of another length than the
query's are no candidates; rows with the query's own id are no candidates
(ids are taken to be unique; a repeated row is a candidate of others each
time).  Fewer than k candidates: all of them.  Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticklake.llm.common import blocks_for, store, valid_vector

ROWS_PER_BLOCK = 32_768
QUERIES_PER_BLOCK = 256

INDEX_SCHEMA = "iblk long, dim int, bits int, base long, rows int, ids binary, slices binary"
HIT_SCHEMA = "query_id long, qkey long, vec_id long, score long"


LARGEST = 2.0 ** 62         # quantised components beyond it count as it
LONG = 2 ** 63              # scores beyond a long count as the largest (least) long


def quantise(vectors: DataFrame, id_col: str, vec_col: str, scale: int = 64) -> DataFrame:
    """(vec_id, q array<long>) of the vectors that take part; ``LARGEST`` bounds q."""
    def integer(x: Column) -> Column:
        return F.floor(F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.lit(scale) * x.cast("double")))).cast("long")

    return (vectors.where(valid_vector(F.col(vec_col)))
            .select(F.col(id_col).cast("long").alias("vec_id"), F.transform(vec_col, integer).alias("q"))
            .where("vec_id IS NOT NULL"))


def build_index(quantised: DataFrame, n_blocks: int) -> DataFrame:
    """One row per (block, vector length): ids in order and packed slices."""

    def pack(table: pa.Table) -> pa.Table:
        ids = table["vec_id"].to_numpy()
        dim = int(table["dim"][0].as_py())
        q = table["q"].combine_chunks().flatten().to_numpy().reshape(len(ids), dim)
        order = np.argsort(ids, kind="stable")
        ids, q = ids[order], q[order]
        base = int(q.min()) if q.size else 0
        u = (q - base).astype(np.uint64)
        bits = max(1, int(u.max()).bit_length()) if q.size else 1
        words = -(-len(ids) // 64)
        out = np.zeros((dim, bits, words * 8), dtype=np.uint8)
        for b in range(bits):
            plane = ((u >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
            out[:, b, :-(-len(ids) // 8)] = np.packbits(plane, axis=0, bitorder="little").T
        return pa.table({"iblk": pa.array([table["iblk"][0].as_py()], pa.int64()),
                         "dim": pa.array([dim], pa.int32()), "bits": pa.array([bits], pa.int32()),
                         "base": pa.array([base], pa.int64()), "rows": pa.array([len(ids)], pa.int32()),
                         "ids": pa.array([ids.tobytes()], pa.binary()),
                         "slices": pa.array([out.tobytes()], pa.binary())})

    rows = quantised.select(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).alias("iblk"),
                            F.size("q").alias("dim"), "vec_id", "q")
    return rows.groupBy("iblk", "dim").applyInArrow(pack, INDEX_SCHEMA)


def pack_queries(queries: DataFrame, n_blocks: int) -> DataFrame:
    """One row per (query block, vector length) with the queries' integers."""
    q = queries.select("vec_id", "q", F.xxhash64("q").alias("qkey")).dropDuplicates(["vec_id", "qkey"])
    return (q.groupBy(F.pmod(F.xxhash64("vec_id", "qkey"), F.lit(n_blocks)).alias("qblk"), F.size("q").alias("dim"))
            .agg(F.collect_list(F.struct("vec_id", "qkey", "q")).alias("qs")))


def add_slices(columns: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Add bitmaps given per weight (columns[w] has weight 2**w; each entry
    is an array of shape (n, words)): full adders compress every weight's
    bitmaps three to two until one is left."""
    out: list[np.ndarray] = []
    w = 0
    while w < len(columns):
        parts = [p for p in columns[w] if len(p)]
        col = parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else None
        if col is None:
            out.append(None)
            w += 1
            continue
        while len(col) > 1:
            if len(columns) == w + 1:
                columns.append([])
            m = len(col) // 3
            if m:
                a, b, c = col[:m], col[m:2 * m], col[2 * m:3 * m]
                x = a ^ b
                columns[w + 1].append((a & b) | (x & c))
                x ^= c
                col = np.concatenate([x, col[3 * m:]]) if len(col) > 3 * m else x
            else:                                   # two left: a half adder
                columns[w + 1].append(col[:1] & col[1:])
                col = col[:1] ^ col[1:]
        out.append(col[0])
        w += 1
    return out


def select_top(slices: list[np.ndarray], eligible: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(certain, boundary) bitmaps: rows surely in the top k, and rows that
    tie on every slice for the places left."""
    sure = np.zeros_like(eligible)
    n_sure = 0
    for s in reversed(slices):
        ones = eligible if s is None else eligible & s
        if s is None:
            continue
        n = int(np.bitwise_count(ones).sum())
        if n_sure + n > k:
            eligible = ones
        else:
            sure = sure | ones
            n_sure += n
            eligible = eligible & ~s
            if n_sure == k:
                return sure, np.zeros_like(eligible)
    return sure, eligible


def set_rows(bitmap: np.ndarray) -> np.ndarray:
    """Row numbers of the set bits, looking into non-zero words only."""
    words = np.flatnonzero(bitmap)
    bits = np.unpackbits(bitmap[words].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    w, b = np.nonzero(bits)
    return words[w] * 64 + b


class Block:
    """A block of the index, as the search sees it."""

    def __init__(self, dim: int, bits: int, base: int, rows: int, ids: bytes, slices: bytes):
        self.ids = np.frombuffer(ids, dtype=np.int64)
        self.bits, self.base, self.dim = bits, base, dim
        words = -(-rows // 64)
        self.pos = np.frombuffer(slices, dtype=np.uint64).reshape(dim, bits, words)
        self.neg = ~self.pos
        all_rows = np.zeros(words * 64, dtype=np.uint8)
        all_rows[:rows] = 1
        self.all_rows = np.packbits(all_rows, bitorder="little").view(np.uint64)

    def top(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        eligible = self.all_rows
        lo, hi = np.searchsorted(self.ids, [query_id, query_id + 1])
        if lo < hi:
            eligible = eligible.copy()
            for i in range(lo, hi):
                eligible[i >> 6] &= ~(np.uint64(1) << np.uint64(i & 63))
        mag = np.abs(q)
        top = int(mag.max()).bit_length() if len(q) else 0
        columns: list[list[np.ndarray]] = [[] for _ in range(top + self.bits)]
        for b in range(top):
            has = (mag >> b) & 1 == 1
            plus, minus = np.flatnonzero(has & (q > 0)), np.flatnonzero(has & (q < 0))
            for j in range(self.bits):
                if len(plus):
                    columns[b + j].append(self.pos[plus, j])
                if len(minus):
                    columns[b + j].append(self.neg[minus, j])
        slices = add_slices(columns)
        sure, tied = select_top(slices, eligible, k)
        rows = set_rows(sure)
        if len(rows) < k:
            rows = np.concatenate([rows, set_rows(tied)[:k - len(rows)]])
        # whole numbers of any size: a few rows, and large components pass the range of a long
        score = [0] * len(rows)
        for w, s in enumerate(slices):
            if s is not None:
                bit = (s[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)
                for i in np.flatnonzero(bit).tolist():
                    score[i] += 1 << w
        # sum q*a = sum over q>0 of q*(u+base) + sum over q<0 of |q|*(~u) - |q|*(full + base)
        full = (1 << self.bits) - 1
        shift = sum(q[q > 0].tolist()) * self.base - sum(mag[q < 0].tolist()) * (full + self.base)
        return self.ids[rows], np.array([max(-LONG, min(LONG - 1, s + shift)) for s in score], dtype=np.int64)


def search(vectors: DataFrame, id_col: str, vec_col: str, is_query: Column, k: int, scale: int = 64,
           rows_per_block: int = ROWS_PER_BLOCK, queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of highest integer inner
    product per query (rows for which ``is_query``, over ``vec_id``, holds),
    ties to the smaller id.  Each (query block, index block) pair is one
    task-sized piece of work; a pair returns at most k rows per query."""
    rows = store(quantise(vectors, id_col, vec_col, scale), "bsi-rows")
    queries = rows.where(is_query)
    n_rows, n_queries = rows.count(), queries.count()
    n_iblk, n_qblk = blocks_for(n_rows, rows_per_block), blocks_for(n_queries, queries_per_block)
    index = build_index(rows, n_iblk)
    packed = pack_queries(queries, n_qblk)
    pairs = (index.withColumn("qblk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_qblk - 1).cast("long"))))
             .join(packed.withColumn("iblk", F.explode(F.sequence(F.lit(0).cast("long"),
                                                                   F.lit(n_iblk - 1).cast("long")))),
                   ["iblk", "qblk", "dim"])
             .repartition(max(1, min(n_iblk * n_qblk, 10_000)), "iblk", "qblk"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r] for n in batch.schema.names}
                block = Block(*(row[n].as_py() for n in ("dim", "bits", "base", "rows", "ids", "slices")))
                out: list[list[np.ndarray]] = [[], [], [], []]
                for q in row["qs"].as_py():
                    ids, score = block.top(q["vec_id"], np.array(q["q"], dtype=np.int64), k)
                    for o, v in zip(out, (np.full(len(ids), q["vec_id"]), np.full(len(ids), q["qkey"]), ids, score),
                                    strict=True):
                        o.append(v)
                yield pa.record_batch([pa.array(np.concatenate(o).astype(np.int64)) for o in out],
                                      names=["query_id", "qkey", "vec_id", "score"])

    hits = pairs.mapInArrow(run, HIT_SCHEMA)
    best = Window.partitionBy("query_id", "qkey").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
