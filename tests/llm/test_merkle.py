"""The manifest against plain trees, with small and with several tiers of blocks."""

import hashlib
import random
import zlib

import pytest

from ticklake.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, h string, item int, grp string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """Root and the (left, right) steps of each node."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 3] for i in range(0, len(nodes), 3)]
        for k, i in enumerate(at):
            run = runs[i // 3]
            steps[k].append(("".join(run[:i % 3]), "".join(run[i % 3 + 1:])))
        at, nodes = [i // 3 for i in at], [H(*r) for r in runs]
    return nodes[0], steps


def plain(rows):
    groups, out = {}, []
    for r in rows:
        groups.setdefault(b"" if r[1] is None else b"=" + r[1].encode(), []).append(r)
    subs = {}
    for g, rs in groups.items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subs[g] = tree([leaf(r) for r in rs])
    order = sorted(subs)
    root, tops = tree([subs[g][0] for g in order])
    for g, top in zip(order, tops, strict=True):
        for r, steps in zip(groups[g], subs[g][1], strict=True):
            steps = steps + top
            lost = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            h = leaf((*r[:4], r[4].replace("\n", "") if lost and r[4] is not None else r[4]))
            for a, b in steps:
                h = H(a, h, b)
            out.append((r[0], leaf(r), subs[g][0], root, H(*(a + b for a, b in steps)), h, h == root))
    return sorted(out, key=str)


def rows_of(sizes, rng=random.Random(3)):
    rows = [(rng.randrange(10_000), s, rng.choice(["en", None]), rng.choice([None, 5]),
             rng.choice([None, "", "é\nx", "no break", "\n"])) for s, n in sizes.items() for _ in range(n)]
    rng.shuffle(rows)
    return rows


def got(frame, rows):
    df = frame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in merkle.audit_documents(df).collect()), key=str)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_trees(frame, monkeypatch, levels):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3 ** levels)
    sizes = {None: 1, "": 2, "a": 3, "b": 4, "é": 9, "z": 10, "c": 28, "hot": 130}
    rows = rows_of(sizes if levels > 1 else {None: 1, "a": 4, "hot": 30})
    assert got(frame, rows) == plain(rows)


def test_edge_cases(frame):
    assert got(frame, []) == []
    one = [(7, None, None, None, None)]
    assert got(frame, one) == plain(one)
    same = [(None, "s", "en", 1, "a\nb")] * 5 + [(3, "s", "en", 1, "x" * 300_000 + "\n")] * 4
    assert got(frame, same) == plain(same)


def test_blocks_of_several_partitions(frame):
    rows = rows_of({"hot": 900, "b": 1, "c": 1})
    assert got(frame, rows) == plain(rows)
