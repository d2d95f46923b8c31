"""The template language, and conversations against a plain formatter."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ticklake.llm import chat
from ticklake.llm.template import Const, Emit, Op, Template, TemplateError, Text, marked


def text(source, **values):
    return Template(source).text(**values)


@pytest.mark.parametrize("source,values,want", [
    ("a{{ 1 + 2 * 3 }}b", {}, "a7b"),
    ("{{ 'x' ~ (1 - 3) ~ none ~ true }}", {}, "x-2true"),
    ("{{ x.y[1] | upper }}", {"x": {"y": ["p", "q"]}}, "Q"),
    ("{{ missing.member | default('-') }}", {}, "-"),
    ("{% if a and not b %}1{% elif b %}2{% else %}3{% endif %}", {"a": True, "b": True}, "2"),
    ("{% if 'a' in x and x is string %}1{% endif %}{% if 3 not in [1, 2] %}2{% endif %}", {"x": "cat"}, "12"),
    ("{% for t in ts %}{{ loop.index }}{{ t }}{{ ', ' if not loop.last }}{% endfor %}", {"ts": "ab"}, "1a, 2b"),
    ("{% set n = 2 %}{% for t in ts %}{% set n = n + t %}{{ n }}{% endfor %}|{{ n }}", {"ts": [1, 2]}, "34|2"),
    ("a {#- gone -#} b {%- if true %} c {% endif %}", {}, "ab c "),
    (r"{{ 'it\'s\n' }}{{ '{{ 1 }}' | length }}", {}, "it's\n7"),
    ("{{ x is none }}{{ x is not defined }}{{ 7 // 2 }}{{ 7 % 4 }}{{ -1 < 0 }}", {}, "truetrue33true"),
    ("{{ '1' if a else '2' if b else '3' }}{{ [1, 'é'] | tojson }}", {"b": 1}, '2[1, "é"]'),
])
def test_language(source, values, want):
    if "{{ 1 }}" in source:                       # a delimiter inside a string ends the expression: refused
        with pytest.raises(TemplateError):
            text(source, **values)
        return
    assert text(source, **values) == want


@pytest.mark.parametrize("source", [
    "{% if x %}", "{% endif %}", "{{ x", "{{ 1 + }}", "{{ f(1) }}", "{{ x | nofilter }}", "{% for x in %}{% endfor %}",
    "{% set if = 1 %}", "{% while x %}", "{{ x is odd }}", "{{ 9223372036854775808 }}", "{{ a b }}", "{% if %}{% endif %}"])
def test_faulty_templates(source):
    with pytest.raises(TemplateError):
        Template(source)


def test_sandbox():
    assert text("{{ x.__class__ }}{{ x['__init__'] }}{{ s.upper }}", x={"a": 1}, s="s") == ""
    for source in ("{{ 'a' * 9 }}", "{{ 4611686018427387904 * 2 }}", "{{ x < 'a' }}", "{{ 1 // 0 }}", "{{ 1 + '1' }}"):
        with pytest.raises(TemplateError):
            text(source, x=1)
    assert text("{% if false %}{{ 1 // 0 }}{% endif %}ok") == "ok"


def test_folding():
    t = Template("a{{ 'b' | upper }}{% if 1 < 2 %}c{{ x ~ ('d' ~ 'e') }}{% else %}f{% endif %}{% if x and false %}{% endif %}")
    assert t.tree[:2] == (Text("aBc"), Emit(Op("~", (t.tree[1].value.args[0], Const("de")))))
    assert Template("{{ 'a' }}{% if true %}b{% endif %}{# c #}d").tree == (Text("abd"),)


def test_loops_are_streams():
    def turns():
        for i in range(3):
            seen.append(i)
            yield i
    seen, got = [], Template("{% for t in ts %}{{ t }}{% endfor %}").render(ts=turns())
    assert next(got) == ("0", False) and seen == [0, 1]


def test_marks():
    t = Template("u{% generation %}a{{ x }}{% endgeneration %}{% generation %}b{% endgeneration %}c{% generation %}{% endgeneration %}")
    assert marked(t.render(x="é")) == ("uaébc", [(1, 4)])


ALPHABET = st.lists(st.sampled_from(["\\", "### ", "</turn>", "<:>", "#", " ", "<", "a", "é", "\n", "### User: "]),
                    max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "a<:>b\\"]), ALPHABET), max_size=5),
       st.integers(1, 9))
def test_escape_and_read_back(turns, size):
    escape = chat.Escape()
    for _, t in turns:
        assert escape.undo(escape.escape(t)) == t
        assert not any(c in escape.escape(t) for c in chat.CONTROLS)
    template = Template(chat.CHAT, {"escape": escape.escape})
    rendered = list(template.render(turns=iter([{"role": r, "text": t} for r, t in turns])))
    reader = chat.Reader(escape)
    for piece, spans in chat.parts(rendered, size):
        assert len(piece) <= size
        reader.feed(piece, spans)
    learnt = "".join(t for r, t in turns if r == "assistant")
    assert reader.result(1) == (
        1, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(learnt),
        hashlib.sha256(learnt.encode()).hexdigest(), len("".join(t for t, _ in rendered)))


def plain(rows):
    out = {}
    for conv, turn, role, t in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", t or ""))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return sorted(((c, len(ts), digest("".join(f"{r}\n{t}\n" for r, t in ts)),
                    len(le := "".join(t for r, t in ts if r == "assistant")), digest(le)) for c, ts in out.items()), key=str)


def test_conversations(frame):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a\\</turn>\n### b"), (1, None, None, "first"), (2, 0, "assistant", None),
            (2, 0, "assistant", "x"), (2, 0, "assistant", "x"), (None, 3, "user", "z"), (3, 0, "assistant", "é" * 50_000),
            (3, 1, "tool <:>", "y" * 50_000), (4, 0, "", "")]
    df = frame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, part string")
    parts = chat.format_conversations(df, part_chars=1000)
    assert sorted((r[:5] for r in chat.read_back(parts).collect()), key=str) == plain(rows)
    got = {(r.conv_id, r.part): r for r in parts.collect()}
    assert got[2, 0].text == "### Assistant: </turn>\n" + "### Assistant: x</turn>\n" * 2
    assert [tuple(s) for s in got[2, 0].loss] == [(38, 39), (62, 63)]
    assert max(len(r.text) for r in got.values()) == 1000 and len([k for k in got if k[0] == 3]) > 90
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_own_template(frame):
    df = frame([(1, 0, "user", "a|b")], "conv_id long, turn long, role string, text string")
    made = chat.format_conversations(df, "{% for t in turns %}[{{ t.text | escape }}]{% endfor %}", controls=["|"])
    assert made.select("text").first()[0] == "[a\\ab]"
    with pytest.raises(TemplateError):
        chat.format_conversations(df, "{% for %}")
