"""Chat formatting with spans found by rendering, not by knowledge of the template.

A template is a black box: turns in, one string out. Which characters belong to
which turn is found by incremental rendering: the output of the first k turns is
compared with the output of the first k + 1, and what is new is the span of turn
k + 1. Where the longer output does not start with the shorter one, the template
rewrites history; such a conversation is marked and gets neither spans nor a mask.
Within a span, the text's place is found by rendering the turn with two other
texts: what all share in front and behind is the frame.

Rendering every prefix costs the square of a conversation's length. So a
conversation of more than ``CONTEXT`` turns is rendered in windows: its first
turn and the latest ``CONTEXT`` ones. The spans found in windows must spell, one
after the other, exactly the rendering of the whole conversation; if they do not,
the template looks further back, and every prefix is rendered after all.

``ChatMarks`` is the template of the registered query: control strings around
turns, and an escape within texts that is undone exactly (``unescape``).

Spark sorts the rows by conversation and turn; a task goes through its rows in
that order and holds one conversation at a time. A conversation is one string by
nature, so a task's memory and time grow with the longest one (about 12 bytes a
character), not with the number of turns that share a task.

Cases: a null text or role counts as empty; a null turn comes first, equal turns
are ordered by role and text; repeated rows are turns of their own; rows without
a conv_id are one conversation with a null id; an empty table gives an empty
result; further columns, named like results or not, are ignored; a conversation
without an assistant turn has an empty mask.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrimtally.llm.base import columns

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

CONTEXT = 4
PROBES = ("a", "b")


class ChatMarks:
    """``<|im_start|>role``, a line end, the text, ``<|im_end|>``, a line end.

    Escaped, no text or role holds ``<|``: a backslash goes in behind the ``<`` of
    every ``<|``, ``<\\|``, ``<\\\\|`` and so on; undone, one comes out. A role's
    backslashes are doubled and its line ends written as ``\\n`` before that.
    """

    start, end = "<|im_start|>", "<|im_end|>"
    _plain = re.compile(r"<(\\*)\|")
    _escaped = re.compile(r"<\\(\\*)\|")
    _turn = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)

    @classmethod
    def escape(cls, text: str) -> str:
        return cls._plain.sub(r"<\\\1|", text)

    @classmethod
    def unescape(cls, text: str) -> str:
        return cls._escaped.sub(r"<\1|", text)

    @classmethod
    def _role(cls, role: str) -> str:
        return cls.escape(role.replace("\\", "\\\\").replace("\n", "\\n"))

    def __call__(self, turns: list[Turn]) -> str:
        return "".join(f"{self.start}{self._role(r)}\n{self.escape(t)}{self.end}\n" for r, t in turns)

    @classmethod
    def read(cls, output: str) -> list[Turn]:
        """The turns of an output."""
        found, at = [], 0
        while at < len(output):
            turn = cls._turn.match(output, at)
            if turn is None:
                raise ValueError(f"no turn at character {at}")
            role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], cls.unescape(turn[1]))
            found.append((role, cls.unescape(turn[2])))
            at = turn.end()
        return found


def _shared(left: str, right: str, backwards: bool = False) -> int:
    """Length of the longest common prefix, or suffix, by halving."""
    low, high = 0, min(len(left), len(right))
    while low < high:
        middle = (low + high + 1) // 2
        same = left[-middle:] == right[-middle:] if backwards else left[:middle] == right[:middle]
        low, high = (middle, high) if same else (low, middle - 1)
    return low


def _frame(template: Template, before: list[Turn], role: str, known: int) -> tuple[int, int]:
    """Characters in front of a turn's text and behind it, within its span."""
    one, other = (template([*before, (role, p)])[known:] for p in PROBES)
    front = _shared(one, other)
    return front, _shared(one[front:], other[front:], backwards=True)


def _spans(template: Template, before: list[Turn], turns: list[Turn]) -> Iterator[tuple[str, int, int] | None]:
    """(span, front, behind) of each of ``turns`` after ``before``; None where history is rewritten."""
    shown = template(before) if before else ""
    for turn in turns:
        now = template([*before, turn])
        if not now.startswith(shown):
            yield None
            return
        front, behind = _frame(template, before, turn[0], len(shown))
        yield now[len(shown) :], front, behind
        before, shown = [*before, turn], now


class Rendered:
    """A conversation's output, the span of each turn, and the text's place in it.

    ``spans`` holds (start, end, text start, text end) for each turn, or None if
    the template rewrites history; ``rewritten`` is then the first turn whose
    rendering changed what was there before it.
    """

    def __init__(self, template: Template, turns: list[Turn], context: int = CONTEXT):
        self.output = template(turns) if turns else ""
        self.spans: list[tuple[int, int, int, int]] | None = None
        self.rewritten: int | None = None
        found = list(self._windows(template, turns, context)) if len(turns) > context + 1 else None
        if found is None or None in found or "".join(s[0] for s in found) != self.output:
            found = list(_spans(template, [], turns))
        if found and found[-1] is None:
            self.rewritten = len(found) - 1
            return
        self.spans, at = [], 0
        for span, front, behind in found:
            self.spans.append((at, at + len(span), at + front, at + len(span) - behind))
            at += len(span)

    @staticmethod
    def _windows(template: Template, turns: list[Turn], context: int) -> Iterator[tuple[str, int, int] | None]:
        yield from _spans(template, [], turns[: context + 1])
        for k in range(context + 1, len(turns)):
            yield from _spans(template, [turns[0], *turns[k - context : k]], [turns[k]])

    def masked(self, turns: list[Turn], role: str = "assistant") -> list[tuple[int, int]]:
        """(start, end) of the texts that count for the loss; empty texts have none."""
        if self.spans is None:
            return []
        return [(s[2], s[3]) for s, t in zip(self.spans, turns, strict=True) if t[0] == role and s[2] < s[3]]


def _conversations(batches: Iterable[pd.DataFrame]) -> Iterator[tuple[tuple, list[Turn]]]:
    """(key, turns) of sorted rows; a conversation may go on in the next batch."""

    def rows():
        for batch in batches:
            ids = batch["conv_id"].astype("Int64")
            yield from zip(batch["added"], ids, batch["role"], batch["text"], strict=True)

    key = lambda row: (bool(row[0]), None if row[1] is pd.NA else int(row[1]))
    for name, group in groupby(rows(), key):
        yield name, [(role, text) for _, _, role, text in group]


def _each(chats: DataFrame, added: DataFrame | None, schema: str, shape: Callable[[int | None, list[Turn]], tuple]) -> DataFrame:
    """``shape`` of every conversation, in tasks that hold one at a time."""
    types = (("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string"))
    rows = columns(chats, types).withColumn("added", F.lit(False))
    if added is not None:
        rows = rows.unionByName(columns(added, types).withColumn("added", F.lit(True)))
    rows = rows.fillna("", ["role", "text"])
    rows = rows.repartition("added", "conv_id").sortWithinPartitions("added", "conv_id", "turn", "role", "text")
    names = [x.split()[0] for x in schema.split(", ")]

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, size = [], 0
        for (_, conv_id), turns in _conversations(batches):
            found.append(shape(conv_id, turns))
            size += sum(len(t) for _, t in turns)
            if size > 4_000_000 or len(found) >= 2_000:
                yield pd.DataFrame(found, columns=names).astype({"conv_id": "Int64"})
                found, size = [], 0
        if found:
            yield pd.DataFrame(found, columns=names).astype({"conv_id": "Int64"})

    return rows.select("added", "conv_id", "role", "text").mapInPandas(build, schema)


def formatted(chats: DataFrame, template: Template, added: DataFrame | None = None) -> DataFrame:
    """Per conversation: conv_id, formatted, mask (list of [start, end)), rewrites (first such turn, else null).

    ``added`` holds conversations that stay apart from those of ``chats``, even with the same id.
    """

    def shape(conv_id: int | None, turns: list[Turn]) -> tuple:
        rendered = Rendered(template, turns)
        mask = [{"start": s, "end": e} for s, e in rendered.masked(turns)]
        return conv_id, rendered.output, mask, rendered.rewritten

    schema = "conv_id bigint, formatted string, mask array<struct<start:int,end:int>>, rewrites int"
    return _each(chats, added, schema, shape)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def digests(chats: DataFrame, added: DataFrame | None = None, template: ChatMarks | None = None) -> DataFrame:
    """Per conversation what its output says when it is read back; see the columns.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.
    """
    marks = template or ChatMarks()

    def shape(conv_id: int | None, turns: list[Turn]) -> tuple:
        rendered = Rendered(marks, turns)
        read = marks.read(rendered.output)
        said = "".join(f"{role}\n{text}\n" for role, text in read)
        loss = "".join(marks.unescape(rendered.output[s:e]) for s, e in rendered.masked(read))
        return conv_id, len(read), _digest(said), len(loss), _digest(loss), len(rendered.output)

    schema = (
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )
    return _each(chats, added, schema, shape)
