"""Prefix trie of conversations: every distinct beginning is a node, with its
members, children, leaves and the tokens a shared prefix saves.

A turn becomes a 128-bit id (md5 of role and text) and its number of words, so
no text is shuffled.  A conversation is the hex string of its turns' ids:
string order keeps conversations that begin alike together, the shorter first.
Range shards over (ids, conv_id) hold about ``SHARD_TURNS`` turns each; a
prefix shared by many conversations, or one conversation repeated many times,
is split over as many shards as it fills.

In a shard numpy works on padded matrices of turn numbers, ``BAND`` depths at
a time (only rows that reach a band are in its matrix): a lexsort orders the
rows, and the mask of changes between neighbouring rows, OR-accumulated along
the columns, says where the nodes of each depth start.  Three quantities are
sums over a node's rows, which ``reduceat`` takes at every depth:

* members: 1 a row
* leaves:  rows whose whole sequence does not begin the next row's
* saved:   words of the cells, from the node's depth on, that start no node

Each shard is told the last row of the shard before and the first row of the
one after, so these sums are exact and add up where a node spans shards.
Nodes that span (on the path of a shard's first or last row) are recombined by
their prefix; all others are finished in their shard, but for a parent that
spans, whose conv_id is looked up by (shard, depth, side).

The ids of one conversation are together in one task: some 100 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import blocks_for, store

SHARD_TURNS = 100_000
BAND = 16
ID_HEX, ID_BYTES = 32, 16
WORD = r"[^\x20\x09-\x0D]+"
EMPTY = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- conversations as id sequences
def sequences(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text -> (conv_id, ids, words): ids is 32 hex
    digits a turn, words the number of words of each turn's text; turns in
    order (null first; equal turns by role, then id)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("id"),
        F.regexp_count(text, F.lit(WORD)).alias("words"))
    in_order = F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull(), "turn", "role", "id", "words")))
    return (turns.groupBy("conv_id").agg(in_order.alias("t"))
            .select("conv_id", F.array_join(F.col("t.id"), "").alias("ids"), F.col("t.words").alias("words")))


def with_heads(seqs: DataFrame, head: Column, base: Column, longest: int) -> DataFrame:
    """Each conversation's first ``head`` (0 to ``longest``) turns replaced by
    those of the conversation ``base`` (all if it has fewer, none if it is not
    there).  ``base`` must have few conversations to each value."""
    first = seqs.select(F.col("conv_id").alias("_base"), F.substring("ids", 1, longest * ID_HEX).alias("_ids"),
                        F.slice("words", 1, longest).alias("_words"))
    j = seqs.withColumns({"_base": base, "_h": head}).join(first, "_base", "left")
    none = F.array().cast("array<int>")
    own = F.slice("words", F.col("_h") + 1, F.greatest(F.size("words"), F.lit(1)))
    return j.select("conv_id",
                    F.concat(F.substring(F.coalesce("_ids", F.lit("")), F.lit(1), F.col("_h") * ID_HEX),
                             F.substring("ids", F.col("_h") * ID_HEX + 1, F.length("ids"))).alias("ids"),
                    F.concat(F.when(F.col("_h") > 0, F.slice(F.coalesce("_words", none), F.lit(1), F.col("_h")))
                             .otherwise(none), own).alias("words"))


# ---------------------------------------------------------------- one shard
def _shared(a: str | None, b: str | None) -> int:
    """How many first turns two sequences share; -1 if there is no other."""
    if a is None or b is None:
        return -1
    n, lo = min(len(a), len(b)) // ID_HEX, 0
    while lo < n:                                            # prefixes agree up to a point: bisect it
        mid = (lo + n + 1) // 2
        lo, n = (mid, n) if a[:mid * ID_HEX] == b[:mid * ID_HEX] else (lo, mid - 1)
    return lo


class Shard:
    """The rows of one shard, sorted, as flat numpy columns."""

    def __init__(self, conv: np.ndarray, ids: list[str], words: np.ndarray):
        size = np.array([len(x) // ID_HEX for x in ids], np.int64)
        raw = np.frombuffer(bytes.fromhex("".join(ids)), ">u8").reshape(-1, 2)
        # turn numbers in the order of the ids, from 1; 0 pads
        order = np.lexsort((raw[:, 1], raw[:, 0]))
        new = np.ones(len(raw), bool)
        new[1:] = (raw[order[1:]] != raw[order[:-1]]).any(axis=1)
        number = np.empty(len(raw), np.int64)
        number[order] = np.cumsum(new)
        start = np.cumsum(size) - size
        rows = np.argsort(conv, kind="stable")
        for lo in range((int(size.max(initial=0)) - 1) // BAND * BAND, -1, -BAND):     # the last band first: stable
            inside = size[rows] > lo
            part = rows[inside]
            keys = self._matrix(number, start, size, part, lo)
            part = part[np.lexsort(keys.T[::-1])]
            rows = np.concatenate([rows[~inside], part])
        self.rows, self.conv, self.size = rows, conv[rows], size[rows]
        self.number, self.start, self.words = number, start[rows], words.astype(np.int64)

    @staticmethod
    def _matrix(number, start, size, part, lo) -> np.ndarray:
        """Turn numbers of depths lo + 1 .. lo + BAND of some rows, padded with 0."""
        out = np.zeros((len(part), BAND), np.int64)
        for j in range(BAND):
            has = size[part] > lo + j
            out[has, j] = number[start[part[has]] + lo + j]
        return out

    def masks(self, before: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(lo, the sorted rows that are longer than lo, changes): changes[i, j]
        is true where depth lo + j + 1 of row i differs from the row before,
        or any depth above does; ``before``: turns shared with what precedes
        the shard."""
        part = np.flatnonzero(self.size > 0)
        carry = np.ones(len(part), bool)
        lo, size, start = 0, self.size, self.start
        if len(part):
            carry[1:] = np.diff(part) > 1
        while len(part):
            m = self._matrix(self.number, start, size, part, lo)
            change = np.ones(m.shape, bool)
            change[1:] = m[1:] != m[:-1]
            change[0] = np.arange(lo + 1, lo + BAND + 1) > before
            if part[0] > 0:
                change[0] = True
            change[1:, 0] |= carry[1:]
            change = np.logical_or.accumulate(change, axis=1)
            yield lo, part, change
            on = np.flatnonzero(size[part] > lo + BAND)
            carry = change[on, -1]
            carry[1:] |= np.diff(on) > 1
            part, lo = part[on], lo + BAND


def _digest(conv: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, conv.tolist())).encode()).hexdigest() if len(conv) else EMPTY


NODE = ("shard int, depth int, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string, parent_conv_id long, parent_side string, prefix string, parent_prefix string, "
        "left boolean, right boolean, ends string")
_NODE = pa.schema([("shard", pa.int32()), ("depth", pa.int32()), ("conv_id", pa.int64()), ("n_convs", pa.int64()),
                   ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
                   ("ends_sha256", pa.string()), ("parent_conv_id", pa.int64()), ("parent_side", pa.string()),
                   ("prefix", pa.string()), ("parent_prefix", pa.string()), ("left", pa.bool_()), ("right", pa.bool_()),
                   ("ends", pa.string())])


def shard_nodes(conv: np.ndarray, ids: list[str], words: np.ndarray, last_before: str | None,
                first_after: str | None, shard: int) -> pa.Table:
    """The nodes of one shard: finished ones, and parts of those that span.
    ``words`` holds the numbers of all rows, one row after the other."""
    s = Shard(conv, ids, words)
    n, size, conv = len(s.rows), s.size, s.conv
    first, last = ids[s.rows[0]], ids[s.rows[-1]]
    before, after = _shared(last_before, first), _shared(last, first_after)

    starts: dict[int, np.ndarray] = {}                       # depth -> rows that start a node of that depth
    bands = list(s.masks(before))
    cell = np.zeros(len(s.words) + 1, np.int64)              # words of the cells that start no node
    old = np.zeros(len(s.words), bool)
    for lo, part, change in bands:
        for j in range(BAND):
            has = size[part] > lo + j
            if not has.any():
                break
            starts[lo + j + 1] = part[has & change[:, j]]
            keep = part[has & ~change[:, j]]
            old[s.start[keep] + lo + j] = True
    cell[1:] = np.cumsum(np.where(old, s.words, 0))
    # a leaf row: what it says does not begin the next row's
    leaf = np.ones(n, bool)
    shared_next = np.zeros(n, np.int64)
    for lo, part, change in bands:                           # depths that the next row shares
        for j in range(BAND):
            same = part[(size[part] > lo + j) & ~change[:, j]]
            shared_next[same[same > 0] - 1] = lo + j + 1
    if n > 1:
        leaf[:-1] = shared_next[:-1] < size[:-1]
    leaf[-1] = not (first_after is not None and after >= size[-1])

    def hashes(ids_: str, upto: int) -> list[str]:
        h, out = hashlib.md5(), [hashlib.md5().hexdigest()]
        for d in range(upto):
            h.update(ids_[d * ID_HEX:(d + 1) * ID_HEX].encode())
            out.append(h.copy().hexdigest())
        return out
    left_keys, right_keys = hashes(first, max(before, 0)), hashes(last, max(after, 0))

    cols: dict[str, list] = {f.name: [] for f in _NODE}
    # the nodes one depth above: conv_id, first rows, whether the first and the last of them span
    up_conv, up_first, up_left, up_right = None, None, False, False
    depth = 0
    while True:
        inside = np.arange(n) if depth == 0 else np.flatnonzero(size >= depth)
        if not len(inside):
            break
        if depth == 0:
            heads = np.zeros(1, np.int64)
        else:
            begin = starts[depth]
            # rows at the shard's start that go on a node of the shard before
            heads = np.unique(np.concatenate([begin, inside[:1]]))
        at = np.searchsorted(inside, heads)
        until = np.append(at[1:], len(inside))
        total = np.zeros(n, np.int64)
        total[inside] = cell[(s.start + size)[inside]] - cell[s.start[inside] + max(depth - 1, 0)]
        kids = np.zeros(n, np.int64)
        if depth + 1 in starts:
            kids[starts[depth + 1]] = 1
        add = lambda x: np.add.reduceat(x[inside], at)  # noqa: E731, B023
        low = np.minimum.reduceat(conv[inside], at)
        ends = size[inside] == depth
        n_ends = np.add.reduceat(ends.astype(np.int64), at)
        is_left = np.zeros(len(heads), bool)
        is_right = np.zeros(len(heads), bool)
        is_left[0] = before >= depth and inside[0] == 0
        is_right[-1] = after >= depth and inside[-1] == n - 1
        spans = is_left | is_right
        k = len(heads)
        digests, texts = [EMPTY] * k, [None] * k
        for i in np.flatnonzero((n_ends > 0) | spans).tolist():
            mine = conv[inside[at[i]:until[i]][ends[at[i]:until[i]]]]
            if spans[i]:
                texts[i] = ",".join(map(str, mine.tolist()))
            else:
                digests[i] = _digest(mine)
        if depth == 0:
            parent, side = [None] * k, [None] * k
        else:
            above = np.searchsorted(up_first, heads, "right") - 1
            parent = up_conv[above].tolist()
            side = [None] * k
            for i in np.flatnonzero(above == 0).tolist() if up_left else ():
                side[i] = "L"
            for i in np.flatnonzero(above == len(up_first) - 1).tolist() if up_right else ():
                side[i] = side[i] or "R"
        prefix = [(left_keys[depth] if lf else right_keys[depth]) if sp else None
                  for lf, sp in zip(is_left.tolist(), spans.tolist(), strict=True)]
        above_keys = [(left_keys[depth - 1] if lf else right_keys[depth - 1]) if sp and depth else None
                      for lf, sp in zip(is_left.tolist(), spans.tolist(), strict=True)]
        for name, values in (("shard", [shard] * k), ("depth", [depth] * k), ("conv_id", low.tolist()),
                             ("n_convs", (until - at).tolist()), ("n_children", add(kids).tolist()),
                             ("n_leaves", add(leaf.astype(np.int64)).tolist()), ("saved_tokens", add(total).tolist()),
                             ("ends_sha256", digests), ("parent_conv_id", parent), ("parent_side", side),
                             ("prefix", prefix), ("parent_prefix", above_keys), ("left", is_left.tolist()),
                             ("right", is_right.tolist()), ("ends", texts)):
            cols[name] += values
        up_conv, up_first, up_left, up_right = low, heads, bool(is_left[0]), bool(is_right[-1])
        depth += 1
    return pa.table([pa.array(cols[f.name], f.type) for f in _NODE], schema=_NODE)


# ---------------------------------------------------------------- the trie
def _shards(seqs: DataFrame, shard_turns: int) -> DataFrame:
    """Stored range shards (shard, conv_id, ids, words) of stored sequences."""
    turns = seqs.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    spark = seqs.sparkSession
    n = max(blocks_for(turns, shard_turns), 1)
    return store(seqs.repartitionByRange(n, "ids", "conv_id").withColumn("shard", F.spark_partition_id()), "trie-shards") \
        if turns else spark.createDataFrame([], "conv_id long, ids string, words array<int>, shard int")


def _edges(shards: DataFrame) -> DataFrame:
    """(shard, last_before, first_after): what lies beside each shard; one row a shard."""
    row = F.struct("ids", "conv_id")
    ends = shards.groupBy("shard").agg(F.min(row)["ids"].alias("first"), F.max(row)["ids"].alias("last"))
    w = Window.orderBy("shard")                              # as many rows as there are shards
    return ends.select("shard", F.lag("last").over(w).alias("last_before"), F.lead("first").over(w).alias("first_after"))


def _digest_spans(parts: DataFrame) -> DataFrame:
    """(prefix, depth, ends_sha256) of nodes that span shards: their ends, a
    text a shard, hashed as a stream in shard order."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for (depth, prefix), group in groupby(rows, key=lambda r: r[:2]):
            h, some = hashlib.sha256(), False
            for _, _, ends in group:
                if ends:
                    h.update((b"," if some else b"") + ends.encode())
                    some = True
            yield pa.RecordBatch.from_pydict({"depth": pa.array([depth], pa.int32()), "prefix": [prefix],
                                              "ends_sha256": [h.hexdigest()]})

    in_order = parts.repartition("depth", "prefix").sortWithinPartitions("depth", "prefix", "shard")
    return in_order.select("depth", "prefix", "ends").mapInArrow(run, "depth int, prefix string, ends_sha256 string")


OUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(seqs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """(conv_id, ids, words) -> one row a node: see above and ``OUT``.

    Conversations are told apart by conv_id, which must not repeat; a null
    conv_id is left out (``sequences`` makes it one conversation, which has no
    number to be listed by).  No conversation: no node, not even the root."""
    shards = _shards(store(seqs.where(F.col("conv_id").isNotNull()).select("conv_id", "ids", "words"), "trie-sequences"),
                     shard_turns)
    edges = _edges(shards)

    def run(key, rows: pa.Table, edge: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _NODE.empty_table()
        words = rows.column("words").combine_chunks()
        return shard_nodes(rows.column("conv_id").to_numpy(), rows.column("ids").to_pylist(),
                           words.flatten().to_numpy(zero_copy_only=False), edge.column("last_before")[0].as_py(),
                           edge.column("first_after")[0].as_py(), key[0].as_py())

    nodes = store(shards.groupBy("shard").cogroup(edges.groupBy("shard")).applyInArrow(run, NODE), "trie-nodes")
    parts = nodes.where("prefix IS NOT NULL")
    sums = parts.groupBy("depth", "prefix").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.min("parent_prefix").alias("parent_prefix"))
    spanning = store(sums.join(_digest_spans(parts), ["depth", "prefix"]), "trie-spanning")
    above = spanning.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent_prefix"),
                            F.col("conv_id").alias("parent_conv_id"))
    whole = spanning.join(above, ["depth", "parent_prefix"], "left").select(*OUT)
    # parents that span, by the shard and side on which a node sees them
    seen = parts.join(spanning.select("depth", "prefix", F.col("conv_id").alias("_conv")), ["depth", "prefix"]).select(
        "shard", (F.col("depth") + 1).alias("depth"), "_conv",
        F.explode(F.filter(F.array(F.when(F.col("left"), "L"), F.when(F.col("right"), "R")),
                           lambda x: x.isNotNull())).alias("parent_side"))
    done = (nodes.where("prefix IS NULL").join(seen, ["shard", "depth", "parent_side"], "left")
            .withColumn("parent_conv_id", F.coalesce("_conv", "parent_conv_id")).select(*OUT))
    return done.unionByName(whole).withColumn("depth", F.col("depth").cast("long"))
