"""Language-model scores by deleted interpolation.

Tokens are the A-Z lower-cased words of a text and one end token; the model
mixes the maximum-likelihood estimates of bigram and unigram with a uniform
share, P(w | v) = a_b c(v, w) / c(v) + b_b c(w) / N + c_b / (V + 1), where b
is the bucket of the context's frequency c(v) (its bit length).  The weights
of each bucket are learned by expectation-maximisation on documents held out
from the counts that EM sees; the scores then use the counts of all training
documents.  A context never seen has weight on the lower estimates only.

Three kinds of document: test (remainder ``TEST`` of crc32(id) mod ``FOLDS``;
never learned from), tuning (remainder ``TUNE``) and the rest.

How it runs.  Documents are packed once into blocks of about
``BLOCK_TOKENS`` tokens (local vocabulary and token numbers; one kind per
block).  Each block sends its distinct n-grams, as sorted 64-bit hashes with
counts, to the buckets of the hash range; a bucket adds them up and answers
each block with the totals of just the n-grams it sent.  An n-gram that is
frequent everywhere costs one entry per block, so no bucket grows hot, and
nothing of the model is ever in one place.  EM reads the tuning blocks'
estimates once per round and returns a few sums per bucket of contexts.

A null text counts as empty (one end token), a null id as the empty id.
"""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import blocks_for, id_remainder, store

FOLDS, TEST, TUNE = 7, 2, 0
BLOCK_TOKENS = 1_000_000
BUCKET_KEYS = 2_000_000          # distinct n-grams that one bucket adds up, about
EM_ROUNDS = 20
EM_GAIN = 1e-6                   # log-likelihood per token below which EM stops
CONTEXTS = 64                    # buckets of context frequency (bit length of a long)
TRAIN, HELD, OUT = 0, 1, 2       # kinds of block
END_HASH, BEGIN_HASH = 1, 2

BLOCK_SCHEMA = "block long, kind int, ids array<long>, lens array<int>, tokens long, vocab binary, codes binary"


def squeeze(a: np.ndarray) -> bytes:
    """Bytes of an integer array, plane by plane, deflated."""
    return zlib.compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes(), 1)


def unsqueeze(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).reshape(-1)


def pack_block(kind: int, ids: list, lens: list[int], words: dict[bytes | None, int], codes: list[np.ndarray]) -> tuple:
    """A block row; token numbers by falling frequency."""
    flat = np.concatenate(codes)
    order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
    new = np.empty(len(order), np.uint32)
    new[order] = np.arange(len(order), dtype=np.uint32)
    hashes = np.array([END_HASH if w is None else xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)
    return (uuid.uuid4().int >> 65, kind, ids, lens, len(flat), hashes[order].tobytes(), squeeze(new[flat]))


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    rest = id_remainder(F.col(id_col), FOLDS)
    kind = F.when(rest == TEST, OUT).when(rest == TUNE, HELD).otherwise(TRAIN)
    types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.binary()]
    names = ["block", "kind", "ids", "lens", "tokens", "vocab", "codes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fresh():
            words = defaultdict()
            words.default_factory = words.__len__
            return [[], [], words, [], 0]

        open_blocks = {k: fresh() for k in (TRAIN, HELD, OUT)}

        def close(k: int) -> pa.RecordBatch:
            ids, lens, words, codes, _ = open_blocks[k]
            row = pack_block(k, ids, lens, words, codes)
            open_blocks[k] = fresh()
            return pa.record_batch([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names)

        for b in batches:
            for i, k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                at = open_blocks[k]
                words = (t.as_py() or b"").lower().split()
                words.append(None)
                at[0].append(i)
                at[1].append(len(words))
                at[3].append(np.fromiter(map(at[2].__getitem__, words), np.uint32, len(words)))
                at[4] += len(words)
                if at[4] >= BLOCK_TOKENS:
                    yield close(k)
        for k, at in open_blocks.items():
            if at[0]:
                yield close(k)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), kind.cast("int").alias("kind"),
                       F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, BLOCK_SCHEMA)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each pair."""
    x = a * np.uint64(0x9E3779B97F4A7C15) ^ ((b << np.uint64(29)) | (b >> np.uint64(35)))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Tokens:
    """A block's tokens and their distinct n-grams."""

    def __init__(self, vocab: bytes, codes: bytes, lens: list[int]):
        self.hashes = np.frombuffer(vocab, np.uint64)
        self.codes = unsqueeze(codes, np.uint32).astype(np.int64)
        self.lens = np.array(lens, np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.lens)[:-1]])       # first token of each document
        before = np.empty_like(self.codes)
        before[1:] = self.codes[:-1]
        before[self.first] = -1
        self.before = before
        h = self.hashes[self.codes]
        left = np.where(before < 0, np.uint64(BEGIN_HASH), self.hashes[before])
        self.pairs, self.pair_of, self.pair_n = np.unique(mix(left, h), return_inverse=True, return_counts=True)
        order = np.argsort(self.hashes, kind="stable")
        self.words, self.word_n = self.hashes[order], np.bincount(self.codes, minlength=len(order))[order]
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))


def cut_points(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bounds in the sorted keys of equal ranges of the hash space."""
    edges = np.array([(i << 64) // n_buckets for i in range(1, n_buckets)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def send(block_table: DataFrame, n_words: int, n_pairs: int) -> DataFrame:
    """(order, bucket, block, kind, keys, counts) of every block."""
    names = ["order", "bucket", "block", "kind", "keys", "counts"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                t = Tokens(r["vocab"], r["codes"], r["lens"])
                for order, keys, n, parts in ((1, t.words, t.word_n, n_words), (2, t.pairs, t.pair_n, n_pairs)):
                    cuts = cut_points(keys, parts)
                    rows = []
                    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                        if lo < hi:
                            gaps = np.diff(keys[lo:hi], prepend=np.uint64(0))
                            rows.append((order, i, r["block"], r["kind"], squeeze(gaps),
                                         squeeze(n[lo:hi].astype(np.uint32))))
                    if rows:
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), types, strict=True)],
                                              names=names)

    return block_table.select("block", "kind", "lens", "vocab", "codes").mapInArrow(
        run, "order int, bucket int, block long, kind int, keys binary, counts binary")


def answer(sent: DataFrame) -> DataFrame:
    """(block, order, bucket, learned, all, types): totals of the n-grams
    each block sent, over the TRAIN blocks (told to HELD blocks only) and
    over TRAIN and HELD blocks; types (once a bucket): how many n-grams the
    training documents have in it."""

    def run(table: pa.Table) -> pa.Table:
        kinds = table["kind"].to_numpy()
        keys = [np.cumsum(unsqueeze(k.as_py(), np.uint64), dtype=np.uint64) for k in table["keys"]]
        counts = [unsqueeze(c.as_py(), np.uint32) for c in table["counts"]]
        sizes = np.array([len(k) for k in keys])
        distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
        n, kind = np.concatenate(counts).astype(np.float64), np.repeat(kinds, sizes)
        learned = np.bincount(where, n * (kind == TRAIN), len(distinct)).astype(np.uint64)
        every = np.bincount(where, n * (kind != OUT), len(distinct)).astype(np.uint64)
        types = [int((every > 0).sum())] + [0] * (len(kinds) - 1)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        parts = [where[a:b] for a, b in zip(bounds, bounds[1:])]
        return pa.table({
            "block": table["block"], "order": table["order"], "bucket": table["bucket"],
            "learned": pa.array([squeeze(learned[p]) if k == HELD else b"" for p, k in zip(parts, kinds)], pa.binary()),
            "every": pa.array([squeeze(every[p]) for p in parts], pa.binary()), "types": pa.array(types, pa.int64())})

    return sent.groupBy("order", "bucket").applyInArrow(
        run, "block long, order int, bucket int, learned binary, every binary, types long")


def estimates(t: Tokens, words: np.ndarray, pairs: np.ndarray, n_docs: int, n_tokens: int) -> tuple:
    """Per token: context bucket, bigram and unigram estimate, count."""
    by_code = words[t.place]
    w = by_code[t.codes].astype(np.float64)
    context = np.where(t.before < 0, n_docs, by_code[t.before]).astype(np.int64)
    pair = pairs[t.pair_of].astype(np.float64)
    bucket = np.frexp(context.astype(np.float64))[1]                # the bit length; 0 for a context not seen
    return (np.minimum(bucket, CONTEXTS - 1), pair / np.maximum(context, 1), w / max(1, n_tokens), w)


def gathered(blocks_of: DataFrame, answers: DataFrame, run, schema: str) -> DataFrame:
    """Bring each block and its answers together."""

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        got = sorted(right.to_pylist(), key=lambda r: (r["order"], r["bucket"]))

        def totals(order: int, name: str) -> np.ndarray:
            parts = [unsqueeze(r[name], np.uint64) for r in got if r["order"] == order]
            return np.concatenate(parts)
        return run(row, Tokens(row["vocab"], row["codes"], row["lens"]), totals)

    return blocks_of.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(both, schema)


def learn_weights(tuning: DataFrame, answers: DataFrame, n_docs: int, n_tokens: int, n_types: int) -> np.ndarray:
    """(context bucket, [bigram, unigram, uniform]) weights by EM."""
    uniform = 1.0 / (n_types + 1)

    def estimate(row: dict, t: Tokens, totals) -> pa.Table:
        bucket, p2, p1, _ = estimates(t, totals(1, "learned"), totals(2, "learned"), n_docs, n_tokens)
        return pa.table({"bucket": pa.array([bucket.astype(np.uint8).tobytes()], pa.binary()),
                         "p2": pa.array([p2.astype(np.float32).tobytes()], pa.binary()),
                         "p1": pa.array([p1.astype(np.float32).tobytes()], pa.binary())})

    held = store(gathered(tuning, answers, estimate, "bucket binary, p2 binary, p1 binary"), "lm-tuning")
    weights = np.tile([0.4, 0.4, 0.2], (CONTEXTS, 1))
    weights[0] = [0.0, 0.7, 0.3]
    before = -np.inf
    for _ in range(EM_ROUNDS):
        def expect(batches: Iterator[pa.RecordBatch], weights=weights) -> Iterator[pa.RecordBatch]:
            shares, gain = np.zeros((CONTEXTS, 3)), 0.0
            for b in batches:
                for r in b.to_pylist():
                    k = np.frombuffer(r["bucket"], np.uint8)
                    parts = weights[k] * np.stack([np.frombuffer(r["p2"], np.float32),
                                                   np.frombuffer(r["p1"], np.float32),
                                                   np.full(len(k), uniform)], axis=1)
                    total = parts.sum(axis=1)
                    gain += float(np.log(total).sum())
                    for j in range(3):
                        shares[:, j] += np.bincount(k, parts[:, j] / total, CONTEXTS)
            yield pa.record_batch([pa.array([gain]), pa.array([shares.ravel().tolist()], pa.list_(pa.float64()))],
                                  names=["gain", "shares"])

        got = held.mapInArrow(expect, "gain double, shares array<double>").collect()
        shares = np.sum([r["shares"] for r in got], axis=0).reshape(CONTEXTS, 3) if got else np.zeros((CONTEXTS, 3))
        n = shares.sum(axis=1, keepdims=True)
        weights = np.where(n > 0, shares / np.maximum(n, 1e-300), weights)
        # the uniform share never vanishes: a word not seen keeps a probability
        weights = weights * (1 - 1e-6) + np.array([0.0, 0.0, 1e-6])
        gain = sum(r["gain"] for r in got) / max(1.0, float(n.sum()))
        if gain - before < EM_GAIN:
            break
        before = gain
    return weights


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score:
    one row per document."""
    table = store(blocks(docs, id_col, text_col), "lm-blocks")
    sums = {r["kind"]: r for r in table.groupBy("kind").agg(
        F.sum("tokens").alias("tokens"), F.sum(F.size("ids")).alias("docs")).collect()}
    size = lambda *kinds, what: sum(sums[k][what] for k in kinds if k in sums)
    everything = size(TRAIN, HELD, OUT, what="tokens")
    n_pairs = blocks_for(everything, BUCKET_KEYS)
    answers = store(answer(send(table, blocks_for(everything, 4 * BUCKET_KEYS), n_pairs)), "lm-answers")
    n_types = answers.where("order = 1").agg(F.coalesce(F.sum("types"), F.lit(0))).first()[0]
    weights = learn_weights(table.where(F.col("kind") == HELD), answers.where("learned <> X''"),
                            size(TRAIN, what="docs"), size(TRAIN, what="tokens"), n_types)
    n_docs, n_tokens = size(TRAIN, HELD, what="docs"), size(TRAIN, HELD, what="tokens")

    def run(row: dict, t: Tokens, totals) -> pa.Table:
        bucket, p2, p1, count = estimates(t, totals(1, "every"), totals(2, "every"), n_docs, n_tokens)
        share = weights[bucket]
        log_p = np.log10(share[:, 0] * p2 + share[:, 1] * p1 + share[:, 2] / (n_types + 1))
        base = np.log10((count + 1.0) / (n_tokens + n_types + 1.0))
        add = lambda x: np.add.reduceat(x, t.first)
        n = len(t.lens)
        return pa.table({
            "doc_id": pa.array(row["ids"], pa.int64()), "held_out": pa.array([row["kind"] == OUT] * n, pa.bool_()),
            "n_tokens": pa.array(t.lens, pa.int64()), "n_known": pa.array(add((count > 0).astype(np.int64)), pa.int64()),
            "train_tokens": pa.array([n_tokens] * n, pa.int64()), "base_score": pa.array(add(base), pa.float64()),
            "score": pa.array(add(log_p), pa.float64())})

    return gathered(table, answers.select("block", "order", "bucket", "every"), run,
                    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                    "base_score double, score double")
