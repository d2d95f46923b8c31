"""Byte-level BPE as a finite-state transducer, and its streaming decoder.

Encoding.  A text is cut into pieces by the tokenizer's pattern; each piece
is run through a transducer byte by byte.  It rests on a property of BPE: a
token sequence is the encoding of its bytes exactly if every two neighbours
are the encoding of their own bytes.  So the encoding of a prefix is known
by its last token and the prefix before it, and of all tokens that end at a
position only one goes with the token before it.  A position stays open
while some token of the vocabulary could still begin there and reach past
what has been read: the open positions are the suffixes that begin a token,
the longest of them is one node of the token tree, and each node's suffix
link leads to the next shorter one.  Where all open positions share the first
part of their token chains, that part can change no more and is emitted.  A
state is the last token emitted and the bytes read since; states and their
transitions are made when first met and kept (``MAX_STATES``; beyond it the
table starts anew, which costs time and changes nothing).  The lookahead is
bounded by the longest token.

Pieces of up to ``SHORT`` bytes are settled by their end at the latest; those
not met before run through the transducer together, a byte of each at a time,
as numpy columns of nodes and last tokens (``encode_many``).

The merges are compiled to the two parts of each token; which neighbours go
together is decided by undoing merges on both sides of their boundary, and
remembered per pair.

Decoding.  Token bytes are fed to an incremental UTF-8 state machine, which
holds back a character whose bytes have not all come.

Vocabularies are given as {token bytes: rank}; ``load_ranks`` reads the file
format of one base64 token and rank per line.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_STATES = 50_000
MAX_PIECES = 350_000         # pieces remembered; beyond it the table starts anew
MAX_PAIRS = 2_000_000        # decisions on neighbours remembered, likewise
SHORT = 64                   # bytes of a piece that runs through the transducer together with others
GROUP_CHARS = 1_000_000      # characters of the texts that are cut and encoded together
GROUP_PIECES = 200_000       # pieces of a longer text that are encoded together
NARROW = 0x250
WIDE = re.compile("[^\x00-\u024f]")


def load_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in data.splitlines() if x)}


class Transducer:
    """Encodes single pieces (bytes) to token ids.

    A state holds the last token emitted, the bytes since, the last token of
    the encoding of each prefix of them (``ends``: that of no byte, the last
    token emitted, comes first), and the node of the token tree that spells
    their longest suffix which begins a longer token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.size = [0] * (max(self.tokens, default=-1) + 1)
        for r, t in self.tokens.items():
            self.size[r] = len(t)
        # the tokens as a tree: child[node << 8 | byte]; token[node] or -1; grows[node]: longer tokens follow
        self.child: dict[int, int] = {}
        self.token, self.grows, self.depth, self.above = [-1], [True], [0], [0]
        for t, r in ranks.items():
            node = 0
            for byte in t:
                self.grows[node] = True
                at = node << 8 | byte
                if at not in self.child:
                    self.child[at] = len(self.token)
                    self.token.append(-1)
                    self.grows.append(False)
                    self.depth.append(self.depth[node] + 1)
                    self.above.append(at)
                node = self.child[at]
            self.token[node] = r
        # shorter[node]: the node of the longest proper suffix that is in the tree
        self.shorter = [0] * len(self.token)
        for node in sorted(range(1, len(self.token)), key=self.depth.__getitem__):
            if self.depth[node] > 1:
                self.shorter[node] = self.after(self.shorter[self.above[node] >> 8], self.above[node] & 255)
        del self.above
        self.ending: list[tuple[int, ...] | None] = [None] * len(self.token)
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.goes: dict[int, bool] = {}
        self._reset()
        self._columns()

    def _reset(self) -> None:
        self.numbers: dict[tuple[int, bytes], int] = {}
        self.states: list[tuple[bytes, list[int], int]] = []
        self.next: list[dict[int, tuple[int, tuple[int, ...]]]] = []
        self.final: list[tuple[int, ...] | None] = []
        self.state(b"", [-1], 0)

    def _columns(self) -> None:
        """The tree as sorted numpy columns, for many pieces at a time."""
        at = np.fromiter(self.child.keys(), np.int64, len(self.child))
        order = np.argsort(at)
        self.edges = at[order]
        self.targets = np.fromiter(self.child.values(), np.int32, len(self.child))[order]
        self.suffix, self.spelt = np.array(self.shorter, np.int32), np.array(self.token, np.int32)
        near = list(range(len(self.token)))               # the longest suffix that is a token, itself included
        for node in sorted(near, key=self.depth.__getitem__):
            if self.token[node] < 0:
                near[node] = near[self.shorter[node]]
        self.near, self.sizes = np.array(near, np.int32), np.array(self.size, np.int32)
        self.makeable = np.full(len(self.size), -1, np.int8)      # whether merges make the token; -1: not known yet
        self.pairs, self.apart = np.empty(0, np.int64), np.empty(0, bool)

    def after(self, node: int, byte: int) -> int:
        """The longest suffix in the tree once ``byte`` is read (0: none)."""
        while True:
            to = self.child.get(node << 8 | byte)
            if to is not None or not node:
                return to or 0
            node = self.shorter[node]

    def ends_at(self, node: int) -> tuple[int, ...]:
        """The tokens that end where ``node`` does and that merges can make, longest first."""
        found, at = [], node
        while at:
            if self.token[at] >= 0 and self.split(self.token[at]) is not None:
                found.append(self.token[at])
            at = self.shorter[at]
        out = self.ending[node] = tuple(found)
        return out

    def state(self, pending: bytes, ends: list[int], node: int) -> int:
        s = self.numbers.get((ends[0], pending))
        if s is None:
            s = self.numbers[ends[0], pending] = len(self.states)
            self.states.append((pending, ends, node))
            self.next.append({})
            self.final.append(None)
        return s

    def split(self, t: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes t; t itself twice for a single
        byte; None if the merges of its bytes do not come to t."""
        try:
            return self.parts[t]
        except KeyError:
            word = self.tokens[t]
            parts = [word[i:i + 1] for i in range(len(word))]
            while len(parts) > 2:
                rank, i = min((self.ranks.get(parts[i] + parts[i + 1], t), i) for i in range(len(parts) - 1))
                if rank >= t:
                    break
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            self.parts[t] = ((t, t) if len(word) == 1 else
                             (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None)
        return self.parts[t]

    def follows(self, a: int, b: int) -> bool:
        """No merge crosses the boundary of a and b: undo the two tokens'
        merges, latest first; what then touches the boundary must not have
        been mergeable before the merge that was undone (of equal ranks the
        left one comes first)."""
        if len(self.goes) > MAX_PAIRS:
            self.goes.clear()
        ok = self.goes[a << 32 | b] = self._apart(a, b)
        return ok

    def _apart(self, a: int, b: int) -> bool:
        before = 1 << 60                        # merges of a rank below this have been tried at the boundary
        while True:
            across = self.ranks.get(self.tokens[a] + self.tokens[b])
            if across is not None and across < before:
                return False
            single_a, single_b = len(self.tokens[a]) == 1, len(self.tokens[b]) == 1
            if single_a and single_b:
                return True
            if single_b or (a > b and not single_a):
                before, a = a, self.split(a)[1]
            else:
                before, b = b + 1, self.split(b)[0]

    def advance(self, ends: list[int], node: int, more: bytes) -> int:
        """Read bytes: append the last token of each prefix to ``ends``;
        return the node of the longest suffix that is in the tree."""
        child, shorter, ending, size, goes, n = self.child, self.shorter, self.ending, self.size, self.goes, len(ends)
        for byte in more:
            to = child.get(node << 8 | byte)
            while to is None and node:
                node = shorter[node]
                to = child.get(node << 8 | byte)
            if to is None:
                raise ValueError("the vocabulary lacks a single byte")
            node = to
            for t in ending[node] or self.ends_at(node):
                left = ends[n - size[t]]
                if left < 0:
                    break
                ok = goes.get(left << 32 | t)
                if ok or (ok is None and self.follows(left, t)):
                    break
            else:
                raise ValueError("the vocabulary lacks a single byte")
            ends.append(t)
            n += 1
        return node

    def step(self, s: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Make the transition of a state on a byte."""
        pending, ends, node = self.states[s]
        ends, pending = [*ends], pending + bytes((byte,))
        node = self.advance(ends, node, pending[-1:])
        # what every open position's chain of tokens passes through is settled
        while not self.grows[node]:
            node = self.shorter[node]
        n, at = len(pending), node
        tips = {n}
        while at:
            if self.grows[at]:
                tips.add(n - self.depth[at])
            at = self.shorter[at]
        while len(tips) > 1:
            far = max(tips)
            tips.remove(far)
            tips.add(far - self.size[ends[far]])
        cut = tips.pop()
        emitted = self.chain(ends[:cut + 1])
        out = self.next[s][byte] = (self.state(pending[cut:], ends[cut:], node), emitted)
        return out

    def chain(self, ends: list[int]) -> tuple[int, ...]:
        """The tokens that lead to the last of ``ends``."""
        out, size, at = [], self.size, len(ends) - 1
        while at:
            t = ends[at]
            out.append(t)
            at -= size[t]
        return tuple(out[::-1])

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > MAX_STATES:
            self._reset()
        out: list[int] = []
        s, table = 0, self.next
        for byte in piece:
            s, emitted = table[s].get(byte) or self.step(s, byte)
            if emitted:
                out += emitted
        rest = self.final[s]
        if rest is None:
            rest = self.final[s] = self.chain(self.states[s][1])
        out += rest
        return out

    def made(self, tokens: np.ndarray) -> np.ndarray:
        """Whether merges make each of ``tokens``."""
        for t in np.unique(tokens[self.makeable[tokens] < 0]).tolist():
            self.makeable[t] = self.split(t) is not None
        return self.makeable[tokens] == 1

    def go(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``follows`` of many pairs."""
        pair = left.astype(np.int64) << 32 | right
        if len(self.pairs):
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            known = self.pairs[at] == pair
            if known.all():
                return self.apart[at]
        else:
            known = np.zeros(len(pair), bool)
        new = np.unique(pair[~known])
        verdict = np.fromiter((self._apart(p >> 32, p & 0xFFFFFFFF) for p in new.tolist()), bool, len(new))
        if len(self.pairs) + len(new) > MAX_PAIRS:
            self.pairs, self.apart = np.empty(0, np.int64), np.empty(0, bool)
            new, again = np.unique(pair, return_index=True)
            verdict = np.fromiter((self._apart(p >> 32, p & 0xFFFFFFFF) for p in new.tolist()), bool, len(new))
        pairs = np.concatenate([self.pairs, new])
        order = np.argsort(pairs, kind="stable")
        self.pairs, self.apart = pairs[order], np.concatenate([self.apart, verdict])[order]
        return self.apart[np.searchsorted(self.pairs, pair)]

    def encode_many(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each (non-empty) piece, packed: all read a byte at a time together."""
        long_first = sorted(range(len(pieces)), key=lambda i: -len(pieces[i]))
        size = np.array([len(pieces[i]) for i in long_first])
        width, n = int(size[0]), len(pieces)
        data = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in long_first), np.uint8).reshape(n, width)
        ends = np.full((width + 1, n), -1, np.int32)
        node = np.zeros(n, np.int32)
        for j in range(width):
            m = int(np.searchsorted(-size, -j, "left"))               # the first m pieces are longer than j
            todo, frm, byte = np.arange(m), node[:m].astype(np.int64), data[:m, j]
            while len(todo):
                edge = frm << 8 | byte
                at = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
                hit = self.edges[at] == edge
                node[todo[hit]] = self.targets[at[hit]]
                if (frm[~hit] == 0).any():
                    raise ValueError("the vocabulary lacks a single byte")
                todo, frm, byte = todo[~hit], self.suffix[frm[~hit]].astype(np.int64), byte[~hit]
            todo, cand = np.arange(m), self.near[node[:m]]
            while len(todo):
                t = self.spelt[cand]
                if (t < 0).any():
                    raise ValueError("the vocabulary lacks a single byte")
                left = ends[j + 1 - self.sizes[t], todo]
                ok = self.made(t)
                ask = np.flatnonzero(ok & (left >= 0))
                ok[ask] = self.go(left[ask], t[ask])
                ends[j + 1, todo[ok]] = t[ok]
                todo, cand = todo[~ok], self.near[self.suffix[cand[~ok]]]
        # walk each chain of tokens back from its end
        ids, count, at, rows = np.zeros((n, width), "<u4"), np.zeros(n, np.int64), size.copy(), np.arange(n)
        while len(rows):
            t = ends[at[rows], rows]
            count[rows] += 1
            ids[rows, width - count[rows]] = t
            at[rows] -= self.sizes[t]
            rows = rows[at[rows] > 0]
        packed, out = ids.tobytes(), [b""] * n
        for k, (i, c) in enumerate(zip(long_first, count.tolist(), strict=True), 1):
            out[i] = packed[4 * (k * width - c):4 * k * width]
        return out


def narrow_pattern(pattern: str) -> str:
    """The pattern for texts whose characters all lie below ``NARROW``: the
    classes of letters, numbers and white space written out from the
    character database, which the faster standard matcher can run."""
    def members(test) -> str:
        return "".join(re.escape(chr(c)) for c in range(NARROW) if test(chr(c)))

    letters = members(lambda c: unicodedata.category(c)[0] == "L")
    numbers = members(lambda c: unicodedata.category(c)[0] == "N")
    space = r"\t\n\x0b\x0c\r \x85\xa0"
    for inside, outside in ((r"[^\s\p{L}\p{N}]", f"[^{space}{letters}{numbers}]"), (r"\p{L}", f"[{letters}]"),
                            (r"\p{N}", f"[{numbers}]"), (r"\s", f"[{space}]"), (r"\S", f"[^{space}]")):
        pattern = pattern.replace(inside, outside)
    return pattern


class Encoder:
    """Texts to token ids.  ``pieces`` remembers the ids of pieces, as
    little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.fst = Transducer(ranks)
        self.split = regex.compile(pattern)
        self.split_narrow = re.compile(narrow_pattern(pattern))
        self.pieces: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> list[str]:
        """Make ``pieces`` known; returns the long ones, which need not stay so."""
        new = pieces - self.pieces.keys()
        if len(self.pieces) + len(new) > MAX_PIECES:
            self.pieces.clear()
            new = pieces
        raw = {p: p.encode() for p in new}
        together, long = [], []
        for p, data in raw.items():
            whole = self.fst.ranks.get(data)
            if whole is not None:
                self.pieces[p] = struct.pack("<I", whole)
            elif len(data) <= SHORT:
                together.append(p)
            else:
                ids = self.fst.encode(data)
                self.pieces[p] = struct.pack(f"<{len(ids)}I", *ids)
                long.append(p)
        if together:
            self.pieces.update(zip(together, self.fst.encode_many([raw[p] for p in together]), strict=True))
        return long

    def join(self, cut: list[list[str]]) -> list[bytes]:
        long = self.learn(set().union(*cut))
        ids = self.pieces.__getitem__
        out = [b"".join(map(ids, pieces)) for pieces in cut]
        for p in long:
            del self.pieces[p]
        return out

    def pack_many(self, texts: list[str]) -> list[bytes]:
        """The packed ids of texts of together about ``GROUP_CHARS``; a longer text goes in runs of pieces."""
        out: list[bytes] = [b""] * len(texts)
        group: list[tuple[int, list[str]]] = []
        for i, text in enumerate(texts):
            split = self.split if WIDE.search(text) else self.split_narrow
            if len(text) <= GROUP_CHARS:
                group.append((i, split.findall(text)))
                continue
            found, runs = (m.group() for m in split.finditer(text)), []
            while run := list(islice(found, GROUP_PIECES)):
                runs += self.join([run])
            out[i] = b"".join(runs)
        for (i, _), packed in zip(group, self.join([pieces for _, pieces in group]), strict=True):
            out[i] = packed
        return out

    def pack(self, text: str) -> bytes:
        return self.pack_many([text])[0]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.pack(text), "<u4").tolist()


def groups(texts: Iterable[str]) -> Iterator[list[str]]:
    """Runs of texts of together ``GROUP_CHARS`` (or one that is longer)."""
    run, chars = [], 0
    for text in texts:
        if run and chars + len(text) > GROUP_CHARS:
            yield run
            run, chars = [], 0
        run.append(text)
        chars += len(text)
    if run:
        yield run


class Vocabulary:
    """What is broadcast: the ranks, and in each worker the encoder made of
    them, kept from task to task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern, self.made = ranks, pattern, None

    def __getstate__(self):
        return {"ranks": self.ranks, "pattern": self.pattern, "made": None}

    def encoder(self) -> Encoder:
        if self.made is None:
            self.made = Encoder(self.ranks, self.pattern)
        return self.made


class Utf8Machine:
    """Incremental UTF-8: bytes in, whole characters out; an unfinished one
    waits for its other bytes.  Ill-formed bytes raise UnicodeDecodeError."""

    def __init__(self):
        self.held = b""

    def take(self, data: bytes) -> tuple[bytes, str]:
        """The characters completed by ``data``, as bytes and as text."""
        data = self.held + data
        cut = len(data)
        for back in range(1, min(4, len(data)) + 1):
            b = data[-back]
            if b & 0xC0 == 0x80:                     # continuation: look further left
                continue
            need = 1 if b < 0x80 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4
            cut = len(data) - back if need > back else len(data)
            break
        self.held, whole = data[cut:], data[:cut]
        return whole, whole.decode("utf-8")

    def feed(self, data: bytes) -> str:
        return self.take(data)[1]

    def close(self) -> str:
        data, self.held = self.held, b""
        return data.decode("utf-8")


def characters(ids: Iterable[int], tokens: dict[int, bytes], burst: int = 4096) -> Iterator[tuple[bytes, str]]:
    """Whole characters of a token stream, as (bytes, text), a burst of tokens at a time."""
    machine, data = Utf8Machine(), map(tokens.__getitem__, ids)
    while some := b"".join(islice(data, burst)):
        yield machine.take(some)
    if machine.held:
        machine.close()                              # an unfinished character: raises


def decode(ids: Iterable[int], tokens: dict[int, bytes], burst: int = 4096) -> Iterator[str]:
    """Text pieces of a token stream."""
    return (text for _, text in characters(ids, tokens, burst))


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids): one row per
    document; a null text counts as empty.  The vocabulary (fixed in size)
    is broadcast."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(ranks, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.value.encoder()
        tokens = encoder.fst.tokens
        for b in batches:
            cols: list[list] = [[], [], [], []]
            for texts in groups(t.as_py() or "" for t in b.column(1)):
                for packed in encoder.pack_many(texts):
                    ids = np.frombuffer(packed, "<u4")
                    digest = hashlib.sha256()
                    for piece, _ in characters(ids.tolist(), tokens):
                        digest.update(piece)
                    for c, v in zip(cols, (len(ids), hashlib.sha256(packed).hexdigest(), digest.hexdigest(),
                                           ids.astype(np.int32) if with_ids else None), strict=True):
                        c.append(v)
            out = [b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1]), pa.array(cols[2])]
            yield pa.record_batch(out + [pa.array(cols[3], pa.list_(pa.int32()))] * with_ids, names=names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, schema)
