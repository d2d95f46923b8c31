"""Conversations rendered by a chat template, with the spans a model is to
learn, and the reader that takes the result apart again.

``format_conversations`` deals conversations to tasks by their id, orders
their rows there and renders them as a stream: a task holds one turn and one
part at a time, however long the conversation.  What it returns are parts of
at most ``PART_CHARS`` characters: (conv_id, part, text, loss), where loss
holds the (start, end) spans of the part that lie in generation blocks.  The
parts of a conversation lie together, in order, in one partition.

Control strings inside texts are escaped reversibly: a backslash becomes two,
a control string becomes a backslash and its letter.  So no control string
that the template did not write is left in the output, and each backslash in
it begins an escape of two characters.

Defined results: a null text or role counts as empty; a null conv_id is a
conversation of its own; rows of a conversation go by turn (null first), equal
turns by role, then text; a repeated row is a turn of its own; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.template import Template

PART_CHARS = 1 << 20
BATCH_PARTS, BATCH_CHARS = 1000, 8 << 20

# The control strings of the format; escape letters follow their order.
CONTROLS = ("### ", "</turn>", "<:>")
CHAT = """\
{%- for turn in turns -%}
{%- if turn.role == 'system' -%}{{ '### System: ' }}
{%- elif turn.role == 'user' -%}{{ '### User: ' }}
{%- elif turn.role == 'assistant' -%}{{ '### Assistant: ' }}
{%- else -%}{{ '### Role ' ~ (turn.role | escape) ~ '<:>' }}
{%- endif -%}
{%- if turn.role == 'assistant' -%}{%- generation -%}{{ turn.text | escape }}{%- endgeneration -%}
{%- else -%}{{ turn.text | escape }}{%- endif -%}
{{ '</turn>\\n' }}
{%- endfor -%}"""
ROLES = {"System": "system", "User": "user", "Assistant": "assistant"}

SCHEMA = "conv_id long, part int, text string, loss array<struct<start:int,end:int>>"
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_PARTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("text", pa.string()), ("loss", pa.list_(_SPAN))])


class Escape:
    """Reversible escaping of control strings (which hold no backslash)."""

    def __init__(self, controls: Iterable[str] = CONTROLS):
        self.codes = {"\\": "\\\\"} | {c: "\\" + chr(ord("a") + i) for i, c in enumerate(controls)}
        self.plain = {v: k for k, v in self.codes.items()}
        self.find = re.compile("|".join(map(re.escape, self.codes)))
        self.found = re.compile(r"\\.", re.S)

    def escape(self, text: str) -> str:
        return self.find.sub(lambda m: self.codes[m[0]], text or "")

    def undo(self, text: str) -> str:
        return self.found.sub(lambda m: self.plain[m[0]], text)


def parts(rendered: Iterable[tuple[str, bool]], size: int) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """The rendered stream cut into texts of at most ``size`` characters, each with its learnt spans."""
    run: list[str] = []
    spans: list[tuple[int, int]] = []
    at, cut = 0, False
    for text, mark in rendered:
        while text:
            take, text = text[:size - at], text[size - at:]
            if mark:
                if spans and spans[-1][1] == at:
                    spans[-1] = (spans[-1][0], at + len(take))
                else:
                    spans.append((at, at + len(take)))
            run.append(take)
            at += len(take)
            if at == size:
                yield "".join(run), spans
                run, spans, at, cut = [], [], 0, True
    if run or not cut:
        yield "".join(run), spans


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def format_conversations(rows: DataFrame, template: str = CHAT, controls: Iterable[str] = CONTROLS,
                         part_chars: int = PART_CHARS) -> DataFrame:
    """conv_id, turn, role, text -> (conv_id, part, text, loss): see above."""
    controls = tuple(controls)
    Template(template, {"escape": Escape(controls).escape})        # a faulty template fails here, not in tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Template(template, {"escape": Escape(controls).escape})
        out, chars = [], 0
        for conv, turns in groupby(_rows(batches), key=lambda r: r[0]):
            rendered = compiled.render(turns=({"role": role, "text": text} for _, role, text in turns))
            for n, (text, spans) in enumerate(parts(rendered, part_chars)):
                out.append((conv, n, text, [{"start": a, "end": b} for a, b in spans]))
                chars += len(text)
                if len(out) == BATCH_PARTS or chars > BATCH_CHARS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PARTS)], schema=_PARTS)
                    out, chars = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PARTS)], schema=_PARTS)

    by_id = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = by_id.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, SCHEMA)


# ---------------------------------------------------------------- reading back
END = "</turn>\n"
TURN = re.compile(r"### (?:(System|User|Assistant): |Role (.*?)<:>)(.*?)</turn>\n", re.S)


class Reader:
    """Takes the parts of one conversation, in order, apart again: digests of
    its turns and of what the mask covers.  Holds one unfinished turn."""

    def __init__(self, escape: Escape):
        self.escape, self.held, self.tail, self.open = escape, [], "", ""
        self.n_turns = self.loss_chars = self.chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, text: str, spans: Iterable[tuple[int, int]]) -> None:
        self.chars += len(text)
        for start, end in spans:
            self._learn(text[start:end])
        self.held.append(text)
        if END not in self.tail + text:                            # the turn goes on in the next part
            self.tail = (self.tail + text)[1 - len(END):]
            return
        text, at = "".join(self.held), 0
        while m := TURN.match(text, at):
            at = m.end()
            role = ROLES[m[1]] if m[1] else self.escape.undo(m[2])
            self.turns.update(f"{role}\n{self.escape.undo(m[3])}\n".encode())
            self.n_turns += 1
        self.held, self.tail = [text[at:]], text[at:][1 - len(END):]

    def _learn(self, text: str) -> None:
        text, self.open = self.open + text, ""
        if (len(text) - len(text.rstrip("\\"))) % 2:               # an escape goes on in the next part
            text, self.open = text[:-1], "\\"
        plain = self.escape.undo(text)
        self.loss_chars += len(plain)
        self.loss.update(plain.encode())

    def result(self, conv: int | None) -> tuple:
        if any(self.held) or self.open:
            raise ValueError(f"conversation {conv}: the formatted text ends inside a turn")
        return conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long")
_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def read_back(formatted: DataFrame) -> DataFrame:
    """Parts as ``format_conversations`` leaves them (same partitions, same
    order) -> one row of digests a conversation, read from the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escape, out = Escape(), []
        for conv, group in groupby(_rows(batches), key=lambda r: r[0]):
            reader = Reader(escape)
            for _, _, text, spans in group:
                reader.feed(text, ((s["start"], s["end"]) for s in spans))
            out.append(reader.result(conv))
            if len(out) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _DIGEST)], schema=_DIGEST)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _DIGEST)], schema=_DIGEST)

    return formatted.select("conv_id", "part", "text", "loss").mapInArrow(run, DIGEST)
