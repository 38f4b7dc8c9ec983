"""Chat formatting: a state machine over roles and a declarative template."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """What marks a turn: ``open`` + label + ``label_end``, the text, ``close``.

    ``labels`` names the roles (others keep their own name), ``loss`` the roles whose
    text is trained on, and ``order`` which role may follow which; ``""`` is the
    start.  Inside texts and labels the ``escape`` character stands before itself
    and before every control string, so a marked turn never appears in one.
    """

    open: str = "### "
    label_end: str = ": "
    close: str = " </turn>\n"
    escape: str = "\\"
    labels: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"})
    loss: frozenset[str] = frozenset({"assistant"})
    order: dict[str, frozenset[str]] = field(default_factory=lambda: {
        "": frozenset({"system", "user"}), "system": frozenset({"user"}), "user": frozenset({"assistant"}),
        "assistant": frozenset({"user", "tool"}), "tool": frozenset({"assistant", "tool"})})
    last: frozenset[str] = frozenset({"assistant"})

    def guarded(self) -> list[str]:
        """What is escaped: the escape and the cores of the marks (the last, which ends
        a label, in labels only)."""
        return [self.escape, self.open.strip(), self.close.strip(), self.label_end.strip()]


class Formatter:
    """Formats turns as segments and reads a formatted text back."""

    def __init__(self, template: Template):
        self.t = t = template
        self._guard = re.compile("|".join(re.escape(s) for s in t.guarded()[:-1]))
        self._guard_label = re.compile("|".join(re.escape(s) for s in t.guarded()))
        token = f"(?P<esc>{re.escape(t.escape)}(?:{'|'.join(re.escape(s) for s in t.guarded())}))"
        self._head = re.compile(f"{re.escape(t.open)}(?P<label>(?:{token}|(?!{re.escape(t.label_end.strip())}).)*){re.escape(t.label_end)}", re.S)
        self._body = re.compile(f"{token}|(?P<close>{re.escape(t.close)})", re.S)
        self._unguard = re.compile(re.escape(t.escape) + "(" + "|".join(re.escape(s) for s in t.guarded()) + ")")
        self._roles = {v: k for k, v in t.labels.items()}

    def escaped(self, text: str, label: bool = False) -> str:
        return (self._guard_label if label else self._guard).sub(lambda m: self.t.escape + m[0], text)

    def plain(self, text: str) -> str:
        return self._unguard.sub(r"\1", text)

    def label(self, role: str) -> str:
        """A role's label; a role that is called like another's label keeps apart by an escape."""
        if role in self.t.labels:
            return self.t.labels[role]
        return ("" if role not in self._roles else "=") + self.escaped(role, True)

    def role(self, label: str) -> str:
        if label in self._roles:
            return self._roles[label]
        return self.plain(label[1:]) if label[:1] == "=" and label[1:] in self._roles else self.plain(label)

    def valid(self, roles: list[str]) -> bool:
        """Whether the machine accepts the roles: each may follow the one before, and
        the last may end a conversation."""
        state = ""
        for r in roles:
            if r not in self.t.order.get(state, ()):
                return False
            state = r
        return state in self.t.last

    def segments(self, turns: list[tuple[str, str]]) -> list[tuple[str, bool]]:
        out: list[tuple[str, bool]] = []
        for role, text in turns:
            out += [(self.t.open + self.label(role) + self.t.label_end, False), (self.escaped(text), role in self.t.loss), (self.t.close, False)]
        return out

    def read(self, text: str) -> list[tuple[str, str]]:
        """Turns of a formatted text: roles and unescaped texts."""
        turns, at = [], 0
        while at < len(text):
            head = self._head.match(text, at)
            if not head:
                raise ValueError(f"no turn at {at}")
            end = next((m for m in self._body.finditer(text, head.end()) if m["close"]), None)
            if end is None:
                raise ValueError(f"turn at {at} does not end")
            turns.append((self.role(head["label"]), self.plain(text[head.end():end.start()])))
            at = end.end()
        return turns


_SEGMENTS = "valid boolean, formatted string, segments array<struct<text:string,loss:boolean>>"


def format_conversations(rows: DataFrame, template: Template = Template(), id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, valid, formatted, segments``.

    Turns go in order of ``turn`` (null first; ties by role, then text).  Null roles
    and texts are empty strings; rows that repeat are turns of their own; a null id
    is a conversation like any other.  A conversation whose roles the machine
    rejects is formatted all the same, with ``valid`` false.  ``segments`` in a row
    are ``formatted``; ``loss`` marks the texts to train on.  A conversation is one
    string in the end, so its rows meet in one task.
    """
    def col(c: str):
        return F.col(f"`{c}`")

    turns = rows.select(col(id_col).alias("conv_id"), F.struct(
        col(turn_col).alias("turn"), F.coalesce(col(role_col), F.lit("")).alias("role"),
        F.coalesce(col(text_col), F.lit("")).alias("text")).alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    @F.pandas_udf(_SEGMENTS)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        f = Formatter(template)
        for part in parts:
            out = []
            for conv in part:
                pairs = [(t["role"], t["text"]) for t in conv]
                segs = f.segments(pairs)
                out.append((f.valid([r for r, _ in pairs]), "".join(s for s, _ in segs), [{"text": s, "loss": x} for s, x in segs]))
            yield pd.DataFrame(out, columns=["valid", "formatted", "segments"])

    return turns.select("conv_id", run.asNondeterministic()("turns").alias("c")).select("conv_id", "c.*")


def read_conversations(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Read formatted conversations back: ``conv_id``, ``turns`` (role, text), ``trained``
    (the unescaped texts of the segments under the loss mask, nothing between),
    ``valid`` and ``formatted``."""
    @F.pandas_udf("turns array<struct<role:string,text:string>>, trained string")
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        f = Formatter(template)
        for texts, segments in parts:
            yield pd.DataFrame({"turns": [[{"role": r, "text": t} for r, t in f.read(x)] for x in texts],
                                "trained": ["".join(f.plain(s["text"]) for s in segs if s["loss"]) for segs in segments]})

    return formatted.withColumn("r", run.asNondeterministic()("formatted", "segments")) \
        .select("conv_id", "valid", "formatted", "r.turns", "r.trained")
