"""Base spans against the plain patterns; the field's further spans."""

import hashlib
import random
import re

import numpy as np

from ticklake.llm import pii

PLAIN = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain(text):
    out = []
    for k, (name, p) in enumerate(PLAIN):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m.group())
            if name == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if name == "card":
                odd = [int(x) for x in d[::-1]]
                total = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(odd))
                if not 14 <= len(d) <= 19 or total % 10:
                    continue
            if name == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    parts = ["a@b.c", "x.y+z@mail-1.example.com", "@", ".", "_d@e.f", "a@b", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8.9",
             "4111 1111 1111 1111", "4111-1111-1111-1111", "4381893557741609", "+1 (279) 555-0216", "+", "+44", " ", "\n",
             "é", "007.001.02.3", "٣", "12", "-", "  ", "%%%", "tel", "5555555555554444", "0" * 17]
    for _ in range(4000):
        t = "".join(rng.choice(parts) + rng.choice(["", " ", "-", "."]) for _ in range(rng.randint(0, 9)))
        assert pii.base_spans(t) == plain(t), t


def test_long_runs_stay_linear():
    for t in ("a" * 400_000, "a" * 400_000 + "@", "1" * 400_000, "1." * 200_000, "+1" + "." * 400_000, "@" * 100_000,
              "a@" * 100_000, "1 " * 200_000):
        pii.base_spans(t)
        assert len(pii.links(t, pii.candidates(t))) <= 3 * 200_000


def docs_frame(frame, texts):
    return frame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, spans string")


def test_query_columns_and_repeats(frame):
    rng = random.Random(4)
    texts = [None, "", "no data", "x" * 100_000]
    for i in range(80):
        phone = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        mail = f"user{i}@mail.example.com"
        texts.append(f"words {mail} more {phone} and 10.0.{i}.7, number {i} of 80")
    # the same digits without what the patterns ask for, told by its other mention
    texts.append("call +1 (279) 555-0216 now and later +1 (279) 555-0216 or x +1 (279) 555-0216")
    df = docs_frame(frame, texts)
    field = pii.train(df)
    got = {r["doc_id"]: r for r in pii.find(df, field).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        base = plain(t or "")
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == j for s in base) for j in range(4)]
        assert got[i]["base_sha256"] == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        every = got[i]["spans"].split(",") if got[i]["spans"] else []
        assert set(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base) <= set(every)
    assert got[0]["spans"] == got[2]["spans"] == ""


def test_skip_links_carry_labels():
    """A token whose own features are undecided takes the label of its repeat."""
    own, pair = np.zeros((pii.N_FEATURES, pii.N_LABELS)), np.zeros((pii.N_LINKS, pii.N_LABELS, pii.N_LABELS))
    own[1, 1], pair[1] = 6.0, 6.0 * np.eye(pii.N_LABELS)
    x = np.zeros((3, pii.N_FEATURES))
    x[0, 1] = 1
    odds = pii.Field(own, pair).marginals(x, np.array([[1, 0, 1]]))
    assert odds[1].argmax() == 1 and odds[1, 1] > 0.9
    assert np.allclose(odds[2], 1 / pii.N_LABELS)


def test_tree_marginals_are_exact():
    """On a graph without cycles belief propagation equals enumeration."""
    rng = np.random.default_rng(3)
    field = pii.Field(rng.normal(size=(pii.N_FEATURES, 5)), rng.normal(size=(pii.N_LINKS, 5, 5)))
    x = rng.integers(0, 2, (3, pii.N_FEATURES)).astype(float)
    edges = np.array([[0, 0, 1], [2, 1, 2]])
    own = x @ field.own
    p = np.exp(own[0][:, None, None] + own[1][None, :, None] + own[2][None, None, :]
               + field.pair[0][:, :, None] + field.pair[2][None, :, :])
    want = np.stack([p.sum((1, 2)), p.sum((0, 2)), p.sum((0, 1))]) / p.sum()
    assert np.allclose(field.marginals(x, edges, rounds=60), want, atol=1e-6)


def steady_field():
    """Only a leading + speaks for a phone; links of neighbours and repeats carry it."""
    own, pair = np.zeros((pii.N_FEATURES, 5)), np.zeros((pii.N_LINKS, 5, 5))
    own[3, 4] = 12.0
    pair[0] = pair[1] = 8.0 * np.eye(5)
    return pii.Field(own, pair)


def test_a_repeat_far_away_is_found():
    text = "+1 2795550216" + " or maybe 2795550216" * 60
    base, every = pii.label_texts([text], steady_field())[0]
    assert len(base) == 1 and len(every) == 61
    assert all(k == 3 and text[s:e].endswith("2795550216") for s, k, e in every)


def test_numbers_are_told_by_their_joined_digits():
    text = "+1 (279) 555-0216 then 279-555-0216 then 2795550216 then (279) 555 0216 but not 2795550217"
    found = [text[s:e] for s, _, e in pii.label_texts([text], steady_field())[0][1]]
    assert found == ["+1 (279) 555-0216", "279-555-0216", "2795550216", "(279) 555 0216"]


def test_messages_pass_until_they_rest():
    own, pair = np.zeros((pii.N_FEATURES, 5)), np.zeros((pii.N_LINKS, 5, 5))
    own[1, 1], pair[2] = 12.0, 8.0 * np.eye(5)
    x = np.zeros((14, pii.N_FEATURES))
    x[0, 1] = 1
    odds = pii.Field(own, pair).marginals(x, np.array([[2, i, i + 1] for i in range(13)]))
    assert (odds[:, 1] > 0.97).all()


def listed(text, kind):
    """What the spans hold if every candidate token is surely of the kind."""
    tokens, base = pii.candidates(text), pii.base_spans(text)
    odds = np.zeros((len(tokens), pii.N_LABELS))
    odds[:, 1 + pii.KINDS.index(kind)] = 1
    return [text[s:e] for s, _, e in sorted(base + pii.further_spans(text, tokens, odds, base))]


def test_a_list_is_one_span_per_entity():
    phones = ["(279) 555-0216", "(279) 555-0217", "(279) 555-0218"]
    assert listed("+1 " + ", ".join(phones), "phone") == ["+1 " + phones[0], *phones[1:]]
    for between in (", ", " ", "\n", "; ", ",\n"):
        assert listed(between.join(phones), "phone") == phones
        assert listed(between.join(p[1:4] + p[5:] for p in phones), "phone") == [p[1:4] + p[5:] for p in phones]
    assert listed("279 555 0216 279 555 0217", "phone") == ["279 555 0216", "279 555 0217"]
    assert listed("06 12 34 56 78", "phone") == ["06 12 34 56 78"]
    assert listed("a@b, c@d e@f", "email") == ["a@b", "c@d", "e@f"]
    cards = ["4111.1111.1111.1111", "5555.5555.5555.4444"]
    assert listed(" ".join(cards), "card") == cards
    cards = [c.replace(".", ". ") for c in cards]
    assert listed(" ".join(cards), "card") == cards


def test_empty_table(frame):
    df = frame([], "doc_id long, text string, spans string")
    assert pii.find(df, pii.train(df)).count() == 0
