"""Line dedup and mixing: small cases, plans without Python, models."""

import hashlib
import random
import re

import pytest

from ticklake.llm import linededup as ld
from ticklake.llm import mixing as mx

DOCS = "doc_id long, text string, lang string, n_lines string, h1 string"


def plain_dedup(rows):
    """[(doc_id, text)] -> {(doc_id, text): kept text}."""
    seen, gone = set(), {}
    for i, t in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0)):
        ls = t.split("\n")
        for p in range(len(ls) - 2):
            w = tuple(ls[p:p + 3])
            if not any(x.strip(" ") for x in w):
                continue
            if w in seen:
                gone.setdefault((i, t), set()).update((p, p + 1, p + 2))
            seen.add(w)
    return {(i, t): None if t is None else "\n".join(x for p, x in enumerate(t.split("\n"))
                                                     if p not in gone.get((i, t), ())) for i, t in rows}


def test_line_windows_against_a_model(frame):
    rng = random.Random(3)
    rows = [(None, "a\nb\nc"), (1, None), (2, ""), (3, "a\nb"), (4, "a\nb\nc\nd"), (5, "z\n" * 400), (6, "\n \n\n\nx"),
            (7, "\n \n\n\nx"), (8, "q\n" + "long " * 20000 + "\ny"), (9, "q\n" + "long " * 20000 + "\ny"), (4, "a\nb\nc\nd")]
    for i in range(10, 60):
        rows.append((i, "\n".join(rng.choice("abcde ") for _ in range(rng.randint(0, 25)))))
    got = ld.dedup_lines(frame([(i, t, "en", "x", "y") for i, t in rows], DOCS), n_lines="total", n_removed="gone")
    assert got.columns == ["doc_id", "text", "lang", "n_lines", "h1", "total", "gone"]
    want = plain_dedup(rows)
    out = got.collect()
    assert len(out) == len(rows)
    assert sorted(str((r["doc_id"], r["text"])) for r in out) == sorted(str((k[0], want[k])) for k in rows)
    for r in out:
        if r["doc_id"] == 5:
            assert (r["total"], r["gone"]) == (401, 399)
        if r["doc_id"] == 1:
            assert (r["total"], r["gone"], r["text"]) == (0, 0, None)


def test_empty_tables(frame):
    none = frame([], "doc_id long, text string, lang string, source string, domain string")
    assert ld.dedup_lines(none).count() == 0
    assert mx.choose(none, ["domain", "lang"], [{}, {}], (1, 2), 2, 1).count() == 0


def water(budget, kids):
    """[(weight, cap)] -> shares, by plain repetition."""
    full = set()
    while True:
        rest = budget - sum(kids[i][1] for i in full)
        w = sum(k[0] for i, k in enumerate(kids) if i not in full)
        more = {i for i, (a, c) in enumerate(kids) if i not in full and c * w <= rest * a}
        if not more:
            return [c if i in full else rest * a // w for i, (a, c) in enumerate(kids)]
        full |= more


def plain_mix(rows, levels, weights, share, epochs, seed):
    rows = [r | {"n": len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))} for r in rows]
    rows = [r for r in rows if r["n"]]
    total = sum(r["n"] for r in rows)
    nodes = {(): min(total * share[0] // share[1], total * epochs)}
    for d, table in enumerate(weights):
        nxt = {}
        for path, b in nodes.items():
            kids = sorted({r[levels[d]] for r in rows if tuple(r[x] for x in levels[:d]) == path}, key=str)
            caps = [epochs * sum(r["n"] for r in rows if tuple(r[x] for x in levels[:d + 1]) == (*path, k)) for k in kids]
            for k, s in zip(kids, water(b, [(table.get(k, 1), c) for k, c in zip(kids, caps)]), strict=True):
                nxt[*path, k] = s
        nodes = nxt
    out = {}
    for path, b in nodes.items():
        leaf = [r for r in rows if tuple(r[x] for x in levels) == path]
        e, rest = divmod(b, sum(r["n"] for r in leaf))
        run = 0
        for r in sorted(leaf, key=lambda r: hashlib.md5(f"{seed}:{e}:{r['doc_id']}".encode()).hexdigest()):
            run += r["n"]
            if e + (run <= rest):
                out[r["doc_id"]] = e + (run <= rest)
    return out


@pytest.mark.parametrize(("share", "epochs"), [((1, 2), 2), ((3, 2), 2), ((9, 1), 3), ((1, 10), 1)])
def test_mixing_against_a_model(frame, share, epochs):
    rng = random.Random(5)
    rows = [{"doc_id": i, "text": " ".join("w" for _ in range(rng.randint(0, 30))), "domain": rng.choice("aab"),
             "lang": rng.choice(["en", "en", "de", None]), "source": rng.choice(["s1", "s1", "s1", "s2", "s3", None])}
            for i in range(400)]
    schema = "doc_id long, text string, domain string, lang string, source string, bucket string, copies string"
    df = frame([(*r.values(), "clash", "clash") for r in rows], schema)
    levels, weights = ["domain", "lang", "source"], [{"a": 1, "b": 6}, {"en": 3}, {"s3": 9}]
    got = {r["doc_id"]: r["copies"] for r in mx.choose(df, levels, weights, share, epochs, 8).collect()}
    assert got == plain_mix(rows, levels, weights, share, epochs, 8)
    mixed = mx.mix(df, levels, weights, share, epochs, 8)
    assert mixed.columns == df.columns and mixed.count() == sum(got.values())


def test_repeated_rows_mix_together(frame):
    rows = [(1, "a b c", "d", "en", "s"), (1, "a b c", "d", "en", "s"), (None, "x y", "d", "en", "s"), (2, None, "d", "en", "s")]
    df = frame(rows, "doc_id long, text string, domain string, lang string, source string")
    assert sorted(map(str, mx.mix(df, ["domain", "lang"], [{}, {}], (1, 1), 1, 1).collect())) == sorted(
        map(str, df.where("text IS NOT NULL").collect()))


def test_native_plans(spark):
    df = spark.range(9).selectExpr("id AS doc_id", "'a\nb\nc' AS text", "'d' AS domain", "'en' AS lang", "'s' AS source")
    for out in (ld.dedup_lines(df), ld.occurrences(df, "doc_id", "text"),
                mx.mix(df, ["domain", "lang"], [{}, {}], (1, 1), 1, 1)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoop"))
