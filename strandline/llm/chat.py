"""8. Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string.
``spans`` renders successive prefixes of a conversation and compares
consecutive outputs: what a turn adds is its span.  A template whose output
for a longer prefix does not begin with the shorter one's rewrites history;
that is reported, and its spans are then taken from the common prefix and
suffix of both outputs in the final rendering, or given up (None).

The template here marks a turn ``<|role|>`` newline text ``<|end|>`` newline.
All control strings, its own and those of other formats (</s>, [INST], <<SYS>>
...), begin with < or [; in texts and roles a backslash is doubled and one is
put after every < and [, in roles after every | too, so no control string survives, and
``unescape`` gives both back exactly.

Where a trained text stands in its turn is found by rendering too: the same
prefix with two other texts in its place shows what comes before and behind.

Edge cases.  Null text or role: empty.  Null turn: before all others; equal
turns are ordered by role, then text.  Null conv_id: one conversation.
Repeated rows are turns each.  Empty table: empty result.  The control
conversation of the query is formatted by itself: an input conversation -1 gives
a row of its own.  A conversation is one output row, so one task holds it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import tidy

Turns = list[tuple[str, str]]
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "<\\").replace("[", "[\\")


def unescape(text: str) -> str:
    return re.sub(r"([<\[\\])\\", r"\1", text)


def escape_role(role: str) -> str:
    return escape(role).replace("|", "|\\")


def unescape_role(role: str) -> str:
    return re.sub(r"([<\[\\|])\\", r"\1", role)


def template(turns: Turns) -> str:
    return "".join(f"{OPEN}{escape_role(r)}{CLOSE}{escape(t)}{END}" for r, t in turns)


_TURN = re.compile(r"<\|([^<|]*(?:[<|]\\[^<|]*)*)\|>\n([^<]*(?:<\\[^<]*)*)<\|end\|>\n")


def read_back(formatted: str) -> Turns:
    """The turns of a formatted conversation."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


@dataclass
class Formatted:
    text: str
    #: of each turn in text: what its rendering added; None if history was rewritten past finding it
    turns: list[tuple[int, int] | None]
    #: of the loss: the texts of turns whose role is trained on
    loss: list[tuple[int, int]]
    rewrites_history: bool


def _grown(old: str, new: str) -> tuple[int, int]:
    """The stretch of ``new`` beyond what it has in common with ``old`` at both ends."""
    limit, a = min(len(old), len(new)), 0
    while a < limit and old[a] == new[a]:
        a += 1
    b = 0
    while b < limit - a and old[-1 - b] == new[-1 - b]:
        b += 1
    return a, len(new) - b


def render(turns: Turns, template: Callable[[Turns], str] = template, trained: tuple[str, ...] = ("assistant",), shown: Callable[[str], str] = escape) -> Formatted:
    """Format turns with a black-box template and locate every turn and the loss.

    ``shown`` is how the template writes a text.  A trained turn's loss is what
    differs between renders of its prefix with other texts in its place, if that is the
    text as shown; else the turn has none.
    """
    out, places, ends, rewrites = template([]), [], [], False
    for k in range(1, len(turns) + 1):
        new = template(turns[:k])
        if new.startswith(out):
            places.append((len(out), len(new)))
        else:
            rewrites = True
            a, b = _grown(out, new)
            places = [p if p and p[1] <= a else None for p in places]
            places.append((a, b))
        out = new
        ends.append(len(new))
    loss = []
    for k, ((role, text), p) in enumerate(zip(turns, places, strict=True)):
        if role in trained and p and text:
            x, y = (template([*turns[:k], (role, probe)]) for probe in "ab")
            a, b = _grown(x, y)
            s, z = shown(text), ends[k] - (len(y) - b)
            if out[a:z] == s and p[0] <= a and z <= p[1]:
                loss.append((a, z))
    return Formatted(out, places, loss, rewrites)


FORMATTED = "conv_id long, formatted string, n_turns long, starts array<long>, ends array<long>, loss_starts array<long>, loss_ends array<long>, rewrites_history boolean"


def formatted(conversations: DataFrame, template: Callable[[Turns], str] = template, trained: tuple[str, ...] = ("assistant",), shown: Callable[[str], str] = escape) -> DataFrame:
    """One row a conversation (see FORMATTED); spans are in code points of the formatted text.

    Conversations stream through a task in order; only the current one is held.
    """
    empty = F.lit("")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), empty).alias("role"), F.coalesce(F.col("text").cast("string"), empty).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("n_turns", pa.int64()), *[(n, pa.list_(pa.int64())) for n in ("starts", "ends", "loss_starts", "loss_ends")], ("rewrites_history", pa.bool_())])

        def done(conv, turns: Turns) -> dict:
            f = render(turns, template, trained, shown)
            return {"conv_id": conv, "formatted": f.text, "n_turns": len(turns), "starts": [p and p[0] for p in f.turns], "ends": [p and p[1] for p in f.turns], "loss_starts": [a for a, _ in f.loss], "loss_ends": [b for _, b in f.loss], "rewrites_history": f.rewrites_history}

        conv, turns = None, []
        for b in batches:
            out = []
            for c, r, t in zip(b.column("conv_id").to_pylist(), b.column("role").to_pylist(), b.column("text").to_pylist(), strict=True):
                if turns and c != conv:
                    out.append(done(conv, turns))
                    turns = []
                conv = c
                turns.append((r, t))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if turns:
            yield pa.RecordBatch.from_pylist([done(conv, turns)], schema=schema)

    return rows.mapInArrow(tidy(run), FORMATTED)


#: A conversation that holds another format's control strings.
CONTROL = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op8(conversations: DataFrame) -> DataFrame:
    control = conversations.sparkSession.createDataFrame(CONTROL, "conv_id long, turn long, role string, text string")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row in b.to_pylist():
                text = row["formatted"]
                turns = read_back(text)
                loss = "".join(unescape(text[a:z]) for a, z in zip(row["loss_starts"], row["loss_ends"], strict=True))
                sha = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                out.append((row["conv_id"], len(turns), sha, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text), row["rewrites_history"]))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 7, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()), strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites_history"])

    return formatted(conversations).unionByName(formatted(control)).mapInArrow(tidy(digest), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites_history boolean")
