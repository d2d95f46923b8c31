"""Personal data by patterns and a skip-chain conditional random field.

Base spans come from four patterns over the whole text (a null text counts
as empty): leftmost, not overlapping within a kind, and failing matches are
dropped.  The field then labels the document's candidate tokens (runs
without white space that hold a digit or @; every other token is observed
to be no personal data).  Its factors are the token's own features, pairs of
neighbouring tokens, and skip links between distant tokens that repeat the
same characters or digits, or that have the same shape.  Links run from each
occurrence to the next, so a token repeated a thousand times costs a
thousand links.  Loopy belief propagation (sum-product, damped) gives each
token's label odds in the light of its whole document, so that an entity
the patterns see in one place is found where its other mentions escape
them.  Runs of tokens with a sure label that no base span touches become
further spans if they hold what their kind must hold, split where an entity
is whole and the next begins; base spans stay.

The weights are learned by pseudo-likelihood from the base spans of at most
``TRAIN_DOCS`` documents (smallest hash of id and text; a document of over
``TRAIN_TOKENS`` candidates is passed over in training only).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The kinds, in their order, and the patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]+(?:[\x20-][0-9]+)*")        # [0-9]([\x20-]?[0-9])+, with less to remember
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TRAIN_DOCS = 4_000
TRAIN_TOKENS = 5_000
ROUNDS = 1_000                   # bound; messages usually rest after some 30 rounds
STILL = 1e-7
SURE = 0.95
MARK = re.compile(r"[0-9@]")
SPACE = re.compile(r"\s")
NOT_DIGIT = re.compile(r"[^0-9]+")
NUMBER_DIGITS = (7, 19)          # of numbers that are told by their digits
LEAST_DIGITS = {"email": 0, "ip": 4, "card": 12, "phone": 7}
MOST_DIGITS = {"email": 0, "ip": 12, "card": 19, "phone": 15}
N_LABELS = len(KINDS) + 1
N_LINKS = 3                      # neighbour, same, alike


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(int(d) for d in digits[::-2])) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """An address needs an @, so each @ is tried: the run of local characters
    to its left (not into the match before), then a domain to its right."""
    done, at = 0, text.find("@")
    low = 0
    while at >= 0:
        low = max(low, done)
        start = low + len(text[low:at].rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        low, at = at + 1, text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), in order."""
    out = []
    if "@" in text:
        out += [(s, 0, e) for s, e in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = NOT_DIGIT.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def candidates(text: str) -> list[tuple[int, int]]:
    """(start, end) of the tokens that hold a digit or @."""
    out, end = [], 0
    hit = MARK.search(text)
    while hit:
        start = hit.start()
        while start > end and not text[start - 1].isspace():
            start -= 1
        stop = SPACE.search(text, hit.end())
        end = stop.start() if stop else len(text)
        out.append((start, end))
        hit = MARK.search(text, end)
    return out


def token_features(token: str) -> list[bool]:
    core = token.strip(".,;:!?*#$%&|\"'()[]<>")
    digits = NOT_DIGIT.sub("", core)
    n, parts = len(digits), core.split(".")
    quad = len(parts) == 4 and all(p.isdigit() and len(p) <= 3 for p in parts)
    letters = any(c.isalpha() for c in core)
    plain = core.isdigit() and core.isascii()
    return [True, "@" in core, "@" in core and "." in core.rpartition("@")[2], token.startswith("+"), "(" in token,
            "-" in core, letters, plain, quad, 14 <= n <= 19 and luhn(digits), n == 0, n <= 3, 4 <= n <= 6,
            7 <= n <= 9, 10 <= n <= 13, 14 <= n <= 19, n > 19, len(core) > 24,
            not letters and n * 2 >= len(core)]


N_FEATURES = len(token_features(""))


def same_key(token: str) -> str:
    digits = NOT_DIGIT.sub("", token)
    return digits if len(digits) >= 7 else token.strip(".,;:!?*#$%&|\"'()[]<>").lower()


def shape_key(token: str) -> str:
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", lambda m: f"d{len(m.group())}", token))


def same_keys(text: str, tokens: list[tuple[int, int]]) -> list[str]:
    """The key of each token: of the numbers of ``NUMBER_DIGITS`` digits that
    it forms alone or with its neighbours, the one most often in the text (the
    longest of those); a token in no repeated number keeps its own key."""
    words = [text[s:e] for s, e in tokens]
    # letters end a number
    digits = ["" if any(c.isalpha() for c in w) else NOT_DIGIT.sub("", w) for w in words]
    numbers, count = [], {}
    for i, d in enumerate(digits):
        j = i
        while d and len(d) <= NUMBER_DIGITS[1]:
            if len(d) >= NUMBER_DIGITS[0]:
                numbers.append((i, j, d))
                count[d] = count.get(d, 0) + 1
            j += 1
            if j == len(tokens) or not digits[j] or tokens[j][0] - tokens[j - 1][1] > 2:
                break
            d += digits[j]
    best = [(1, 0, "")] * len(tokens)
    for i, j, d in numbers:
        if count[d] > 1:
            mark = (count[d], len(d), d)
            for k in range(i, j + 1):
                best[k] = max(best[k], mark)
    return [b[2] or same_key(w) for b, w in zip(best, words, strict=True)]


def links(text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(kind of link, token, later token)."""
    out, last_same, last_alike = [], {}, {}
    for i, ((s, e), same) in enumerate(zip(tokens, same_keys(text, tokens), strict=True)):
        if i and s - tokens[i - 1][1] <= 2:
            out.append((0, i - 1, i))
        for kind, seen, key in ((1, last_same, same), (2, last_alike, shape_key(text[s:e]))):
            j = seen.get(key)
            if j is not None:
                out.append((kind, j, i))
            seen[key] = i
    return out


def tied(edges: list[tuple[int, int, int]], n: int) -> tuple[list[tuple[int, int, int]], int]:
    """The links with every chain of three or more same tokens (of n) tied to
    one further node, and the number of nodes then."""
    root, members, out = list(range(n)), {}, []
    for kind, a, b in edges:
        if kind == 1:
            root[b] = root[a]
            members.setdefault(root[a], [a]).append(b)
        else:
            out.append((kind, a, b))
    for chain in members.values():
        if len(chain) == 2:
            out.append((1, *chain))
        else:
            out += [(1, i, n) for i in chain]
            n += 1
    return out, n


def token_labels(tokens: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[int]:
    """1 + the kind of the first base span that touches the token, else 0."""
    out, j = [], 0
    spans = sorted(spans, key=lambda x: x[2])
    for s, e in tokens:
        while j < len(spans) and spans[j][2] <= s:
            j += 1
        hit = [x for x in spans[j:j + 8] if x[0] < e and x[2] > s]
        out.append(1 + min(hit)[1] if hit else 0)
    return out


class Field:
    """The weights: own (features x labels), pair (link kind x label x label)."""

    def __init__(self, own: np.ndarray, pair: np.ndarray):
        self.own, self.pair = own, pair

    def marginals(self, x: np.ndarray, edges: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
        """Label odds per token, by loopy belief propagation."""
        own = x @ self.own
        belief = own.copy()
        if len(edges):
            kind, a, b = edges.T
            src, dst = np.concatenate([a, b]), np.concatenate([b, a])
            pot = np.concatenate([self.pair[kind], self.pair[kind].transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
            msg = np.zeros((len(src), N_LABELS))
            on = np.arange(len(src))         # messages that may still move
            for _ in range(rounds):
                out = (belief[src[on]] - msg[back[on]])[:, :, None] + pot[on]
                top = out.max(axis=1)
                new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
                step = 0.5 * (new - new.max(axis=1, keepdims=True) - msg[on])
                msg[on] += step
                np.add.at(belief, dst[on], step)
                moved = on[np.abs(step).max(axis=1) > STILL]
                if not len(moved):
                    break
                fresh, stays = np.zeros(len(own), bool), np.zeros(len(src), bool)
                fresh[dst[moved]], stays[moved] = True, True
                on = np.flatnonzero(stays | fresh[src])
        p = np.exp(belief - belief.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def fit(x: np.ndarray, y: np.ndarray, edges: np.ndarray, steps: int = 300, rate: float = 0.5,
        ridge: float = 1e-3) -> Field:
    """Pseudo-likelihood: each token's label given its features and the
    labels at the other ends of its links; gradient ascent with momentum."""
    own, pair = np.zeros((N_FEATURES, N_LABELS)), np.zeros((N_LINKS, N_LABELS, N_LABELS))
    own[0, 0] = 1.0
    if not len(x):
        return Field(own, pair)
    truth = np.eye(N_LABELS)[y]
    speed_own, speed_pair = np.zeros_like(own), np.zeros_like(pair)
    kind, a, b = edges.T if len(edges) else np.zeros((3, 0), int)
    for _ in range(steps):
        z = x @ own
        np.add.at(z, b, pair[kind, y[a]])
        np.add.at(z, a, pair[kind, :, y[b]])
        p = np.exp(z - z.max(axis=1, keepdims=True))
        gap = truth - p / p.sum(axis=1, keepdims=True)
        grad_pair = np.zeros_like(pair)
        np.add.at(grad_pair, (kind, y[a]), gap[b])
        np.add.at(grad_pair.transpose(0, 2, 1), (kind, y[b]), gap[a])
        speed_own = 0.9 * speed_own + rate * (x.T @ gap / len(x) - ridge * own)
        speed_pair = 0.9 * speed_pair + rate * (grad_pair / len(x) - ridge * pair)
        own, pair = own + speed_own, pair + speed_pair
    return Field(own, pair)


def graph(text: str) -> tuple[list, list, np.ndarray, list]:
    """Base spans, candidate tokens, their features and links."""
    if not MARK.search(text):
        return [], [], np.zeros((0, N_FEATURES), bool), []
    spans, tokens = base_spans(text), candidates(text)
    return spans, tokens, np.array([token_features(text[s:e]) for s, e in tokens], dtype=bool), links(text, tokens)


def starts_anew(k: int, run: str, token: str, gap: str) -> bool:
    """Whether a token begins an entity of kind k after the run of tokens of
    that kind: the run must be whole, and the token be set off from it."""
    name, had, more = KINDS[k], NOT_DIGIT.sub("", run), NOT_DIGIT.sub("", token)
    if name == "email":
        return "@" in run and "@" in token
    if len(had) < LEAST_DIGITS[name]:
        return False
    first, last = run.split(maxsplit=1)[0], run.rsplit(maxsplit=1)[-1]
    whole = len(had) >= 10 if name == "phone" else name == "ip" or 14 <= len(had) <= 19 and luhn(had)
    return (last[-1] in ",;|/" or "\n" in gap or len(had) + len(more) > MOST_DIGITS[name]
            or len(NOT_DIGIT.sub("", last)) >= LEAST_DIGITS[name]
            or name == "phone" and token.lstrip("\"'[<")[:1] in ("+", "(")
            or whole and (name != "phone" or shape_key(token) == shape_key(first)))


def further_spans(text: str, tokens: list, odds: np.ndarray, spans: list) -> list[tuple[int, int, int]]:
    """Runs of neighbouring tokens with one sure label, an entity each.
    Tokens that base spans touch are in no run, so a base span ends one."""
    label = np.where(odds.max(axis=1) >= SURE, odds.argmax(axis=1), 0)
    label[np.array(token_labels(tokens, spans), int) > 0] = 0
    out, i = [], 0
    while i < len(tokens):
        k, j = int(label[i]), i + 1
        while (k and j < len(tokens) and label[j] == k and tokens[j][0] - tokens[j - 1][1] <= 2
               and not starts_anew(k - 1, text[tokens[i][0]:tokens[j - 1][1]], text[slice(*tokens[j])],
                                   text[tokens[j - 1][1]:tokens[j][0]])):
            j += 1
        if k:
            s, e = tokens[i][0], tokens[j - 1][1]
            body = text[s:e]
            s += len(body) - len(body.lstrip(".,;:!?*#$%&|\"')[]<>-"))
            e -= len(body) - len(body.rstrip(".,;:!?*#$%&|\"'([]<>-+@"))
            name = KINDS[k - 1]
            if (s < e and len(NOT_DIGIT.sub("", text[s:e])) >= LEAST_DIGITS[name]
                    and ("@" in text[s:e]) == (name == "email")):
                out.append((s, k - 1, e))
        i = j
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = TRAIN_DOCS) -> Field:
    rows = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"), F.col(text_col).alias("text"))
    last = rows.select("h").orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if last is None:
        return fit(np.zeros((0, N_FEATURES)), np.zeros(0, int), np.zeros((0, 3), int))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                spans, tokens, x, edges = graph(t or "")
                if 0 < len(tokens) <= TRAIN_TOKENS:
                    out.append((h, x.astype(np.uint8).tobytes(), bytes(token_labels(tokens, spans)),
                                np.array(edges, np.int32).tobytes()))
            cols = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(
                cols, (pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["h", "x", "y", "e"])

    # copies of a text with one id count once, and go before anything reaches the driver
    got = sorted({tuple(map(bytes, r[1:])) + (r[0],) for r in
                  rows.where(F.col("h") <= last).dropDuplicates(["h"]).mapInArrow(run, "h long, x binary, y binary, e binary").collect()},
                 key=lambda r: r[3])
    x, y, edges, at = [], [], [], 0
    for fx, fy, fe, _ in got:
        x.append(np.frombuffer(fx, np.uint8).reshape(-1, N_FEATURES))
        y.append(np.frombuffer(fy, np.uint8))
        e = np.frombuffer(fe, np.int32).reshape(-1, 3).astype(int)
        edges.append(e + np.array([0, at, at]))
        at += len(y[-1])
    if not got:
        return fit(np.zeros((0, N_FEATURES)), np.zeros(0, int), np.zeros((0, 3), int))
    return fit(np.concatenate(x).astype(float), np.concatenate(y).astype(int), np.concatenate(edges))


def label_texts(texts: list[str], field: Field) -> list[tuple[list, list]]:
    """(base spans, all spans) per text; one field over all texts at once."""
    graphs = [graph(t) for t in texts]
    if not any(g[1] for g in graphs):
        return [([], []) for _ in texts]
    starts, ends, x, edges, at = [], [], [], [], 0
    for _, tokens, features, pairs in graphs:
        pairs, n = tied(pairs, len(tokens))
        starts.append(at)
        ends.append(at + len(tokens))
        # shared nodes have no features
        x += [features, np.zeros((n - len(tokens), N_FEATURES), bool)]
        if pairs:
            edges.append(np.array(pairs, int) + np.array([0, at, at]))
        at += n
    odds = field.marginals(np.concatenate(x).astype(float),
                           np.concatenate(edges) if edges else np.zeros((0, 3), int))
    return [(g[0], sorted(g[0] + further_spans(t, g[1], odds[a:b], g[0])))
            for t, g, a, b in zip(texts, graphs, starts, ends, strict=True)]


def find(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", group: int = 256) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256,
    spans (all, as kind:start:end in code points): one row per document."""
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, group):
                ids = b.column(0)[lo:lo + group].to_pylist()
                texts = [t or "" for t in b.column(1)[lo:lo + group].to_pylist()]
                rows = [(i, *[sum(s[1] == k for s in base) for k in range(4)],
                         hashlib.sha256(joined(base).encode()).hexdigest(), joined(every))
                        for i, (base, every) in zip(ids, label_texts(texts, field), strict=True)]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
