"""Exact cosine top-k, similarity guard and context assembly.

The exact top-k needs every (query, document) score, but never as rows:
queries and documents are hashed into blocks of bounded size; each (query
block, document block) pair meets in one cogroup, where numpy scores it tile
by tile and keeps the k best per query.  A tile is scored in single precision
first, and only pairs that can still be among the k best, by the bound of that
rounding, are scored in double precision.
A final ROW_NUMBER over at most k * (number of document blocks) candidates
per query gives the global top k.  No cartesian product, no broadcast of a
side that grows, nothing passes through the driver except the counts and
lengths used to size the blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.functions.numeric import rnd

TOP_K = 3                  # fixed: neighbours per question
MIN_SIMILARITY = 0.4       # fixed: similarity guard
INSUFFICIENT = "Insufficient data"
BLOCK_VALUES = 1 << 22     # components of a block (32 MB as doubles)
CELLS_PER_CORE = 4         # pairs of blocks for each task slot: they are dealt by hash
TILE = (1024, 2048)        # queries and documents scored at once
RESCORED = 1 << 16         # pairs scored in double precision at once

_PAIR_SCHEMA = T.StructType([
    T.StructField("query_id", T.LongType()), T.StructField("doc_id", T.LongType()),
    T.StructField("similarity", T.DoubleType())])


def _vectors(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, vectors and their lengths, by id; a group holds vectors of one size."""
    ids = rows["id"].to_numpy()
    v = np.concatenate([c.flatten().to_numpy() for c in rows["vec"].chunks]).reshape(len(ids), -1)
    norm = np.linalg.norm(v, axis=1)
    at = np.flatnonzero((norm > 0) & np.isfinite(norm))
    at = at[np.argsort(ids[at], kind="stable")]
    return ids[at], v[at], norm[at]


def _copies_needed(ids: np.ndarray, v: np.ndarray, k: int) -> np.ndarray:
    """Positions (ascending) without the copies of a vector that no query can have among its k:
    k rows of an id and 2 k rows in all, smallest ids first, do whatever id a query leaves out."""
    key = (v * np.random.default_rng(0).random(v.shape[1])).sum(axis=1)
    at = np.lexsort((ids, key))
    new = np.append(True, key[at[1:]] != key[at[:-1]])
    for i in range(0, len(at), RESCORED):                   # rows of one key may still differ
        x = at[i:i + RESCORED + 1]
        new[i + 1:i + len(x)] |= (v[x[1:]] != v[x[:-1]]).any(axis=1)
    for first, most in ((new | np.append(True, ids[at[1:]] != ids[at[:-1]]), k), (new, 2 * k)):
        n = np.arange(len(at))
        ok = n - np.maximum.accumulate(np.where(first, n, 0)) < most
        run = np.cumsum(new)[ok]
        at, new = at[ok], np.append(True, run[1:] != run[:-1])
    return np.sort(at)


def _local_topk(k: int, exclude_self: bool):
    def fn(queries: pa.Table, docs: pa.Table) -> pa.Table:
        out = pa.schema([("query_id", pa.int64()), ("doc_id", pa.int64()), ("similarity", pa.float64())])
        if not queries.num_rows or not docs.num_rows:
            return out.empty_table()
        (qids, qv, qn), (dids, dv, dn) = _vectors(queries), _vectors(docs)
        if not len(qids) or not len(dids):
            return out.empty_table()
        at = _copies_needed(dids, dv, k)
        dids, dv, dn = dids[at], dv[at], dn[at]
        qu, du = (qv / qn[:, None]).astype("float32"), (dv / dn[:, None]).astype("float32")
        margin = (qv.shape[1] + 8) * 2.0 ** -24              # what single precision can be off by
        best, near = np.full((len(qids), k), -np.inf), np.zeros((len(qids), k), dtype="int64")
        # a query's own rows among the documents
        lo, hi = np.searchsorted(dids, qids, "left"), np.searchsorted(dids, qids, "right")
        own_r = np.repeat(np.arange(len(qids)), hi - lo)
        own_c = np.arange(len(own_r)) - np.repeat(np.cumsum(hi - lo) - (hi - lo) - lo, hi - lo)
        for a in range(0, len(qids), TILE[0]):
            z = min(a + TILE[0], len(qids))
            mine = (own_r >= a) & (own_r < z)
            mine_r, mine_c = own_r[mine] - a, own_c[mine]
            for b in range(0, len(dids), TILE[1]):
                s = qu[a:z] @ du[b:b + TILE[1]].T
                if exclude_self:
                    here = (mine_c >= b) & (mine_c < b + TILE[1])
                    s[mine_r[here], mine_c[here] - b] = -np.inf
                low = best[a:z, -1] - margin
                fresh = np.flatnonzero(low == -np.inf)
                if len(fresh) and s.shape[1] > k:
                    low[fresh] = np.partition(s[fresh], -k, axis=1)[:, -k] - 2 * margin
                low = np.nextafter(low.astype("float32"), np.float32(-np.inf))
                r, c = np.divmod(np.flatnonzero(s >= low[:, None]), s.shape[1])      # few: much faster than in two dimensions
                some = s[r, c] > -np.inf
                r, c = r[some] + a, c[some] + b
                if not len(r):
                    continue
                exact = np.concatenate([(qv[r[i:i + RESCORED]] * dv[c[i:i + RESCORED]]).sum(axis=1)
                                        for i in range(0, len(r), RESCORED)]) / (qn[r] * dn[c])
                # with the k best so far: similarity descending, then smaller doc id
                rows = np.unique(r)
                r = np.append(r, np.repeat(rows, k))
                exact, ids = np.append(exact, best[rows].ravel()), np.append(dids[c], near[rows].ravel())
                order = np.lexsort((ids, -exact, r))
                order = order[np.isfinite(exact[order])]
                r, exact, ids = r[order], exact[order], ids[order]
                rank = np.arange(len(r)) - np.searchsorted(r, r)
                top = rank < k
                best[rows] = -np.inf
                best[r[top], rank[top]], near[r[top], rank[top]] = exact[top], ids[top]
        r, i = np.nonzero(best > -np.inf)
        return pa.table([qids[r], near[r, i], best[r, i]], schema=out)
    return fn


def usable(vec: str) -> Column:
    """Neither null nor empty, every component a finite number."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(F.col(vec).isNotNull() & (F.size(vec) > 0) & finite, F.lit(False))


def cosine_topk(queries: DataFrame, docs: DataFrame, k: int = TOP_K, *,
                query_id: str = "query_id", doc_id: str = "doc_id", vec: str = "embedding",
                exclude_self: bool = False, block_rows: int | None = None,
                eps: float = 0.0) -> DataFrame:
    """K nearest documents per query by cosine similarity.

    Returns (query_id, doc_id, rank, similarity, distance = 1 - similarity);
    ties are broken by the smaller doc_id.  Vectors that are null, empty, zero
    or hold a null or non-finite component, and rows without an id, take no
    part, and vectors are compared with those of their own length only.
    Blocks hold ``block_rows`` rows, or as many as make ``BLOCK_VALUES`` numbers.
    """
    def side(df: DataFrame, key: str) -> DataFrame:
        v = df.filter(usable(vec) & F.col(key).isNotNull())
        return v.select(F.col(key).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("vec"),
                        F.size(vec).alias("n"))

    q, d = side(queries, query_id), side(docs, doc_id)
    # as many blocks as bound their size, and enough pairs of blocks for the tasks there are
    spread = math.ceil(math.sqrt(CELLS_PER_CORE * queries.sparkSession.sparkContext.defaultParallelism))
    rows_n, size = zip(*(x.agg(F.count("*"), F.max("n")).first() for x in (q, d)))
    rows = block_rows or max(1, BLOCK_VALUES // max(1, *[n or 1 for n in size]))
    nq, nd = (max(spread, math.ceil(n / rows)) for n in rows_n)
    q = (q.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(nq)))
          .withColumn("db", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nd - 1).cast("long")))))
    d = (d.withColumn("db", F.pmod(F.xxhash64("id"), F.lit(nd)))
          .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nq - 1).cast("long")))))
    part = (q.groupBy("qb", "db", "n").cogroup(d.groupBy("qb", "db", "n"))
             .applyInArrow(_local_topk(k, exclude_self), schema=_PAIR_SCHEMA))
    w = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), F.col("doc_id"))
    top = part.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return top.select(F.col("query_id").alias(query_id), F.col("doc_id").alias(doc_id), "rank",
                      rnd("similarity", 6, eps).alias("similarity"),
                      rnd(F.lit(1.0) - F.col("similarity"), 6, eps).alias("distance"))


def similarity_guard(topk: DataFrame, queries: DataFrame, threshold: float = MIN_SIMILARITY,
                     query_id: str = "query_id") -> DataFrame:
    """Keep neighbours with similarity >= threshold; a query left with
    none gets ``Insufficient data`` and no sources.  Returns the accepted
    neighbours with every query present (left join), doc columns NULL when
    refused."""
    ok = topk.filter(F.col("similarity") >= threshold)
    return queries.select(query_id).distinct().join(ok, query_id, "left")


def assemble_context(guarded: DataFrame, doc_meta: DataFrame, query_id: str = "query_id",
                     doc_id: str = "doc_id") -> DataFrame:
    """Per query, accepted document texts joined by a blank line in rank
    order and the list of sources {url, published_at, ticker}.

    A group holds at most k neighbours, so the ordered collect is bounded.
    """
    j = guarded.join(doc_meta, doc_id, "left")
    item = F.struct("rank", "doc_text", F.struct("url", "published_at", "ticker").alias("src"))
    g = j.groupBy(query_id).agg(
        F.array_sort(F.collect_list(F.when(F.col(doc_id).isNotNull(), item))).alias("_items"))
    n = F.size("_items")
    return g.select(
        query_id,
        n.alias("n_sources"),
        F.when(n == 0, F.lit(INSUFFICIENT)).otherwise(F.lit("answered")).alias("status"),
        F.when(n > 0, F.array_join(F.transform("_items", lambda x: x["doc_text"]), "\n\n")).alias("context"),
        F.transform("_items", lambda x: x["src"]).alias("sources"))
