"""Chat formatting around a template that is only ever called, never looked into.

The template is a function from a list of turns to text. It is called on the first turn, the
first two, and so on; each output is compared with the one before. While the earlier one is a
prefix of the later, the rest is the new turn's span. A template that rewrites what it has said
breaks that, and a new segment begins. Within a span, the text of the turn is what changes
when the template is called with another text: with none, and with a mark that is nowhere else.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]

# Control strings of the template below: fixed values.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[/TURN]")
MARK = "\ue000"

_CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\]|/?ROLE\]|/TURN\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\]|/?ROLE\]|/TURN\])")

SEGMENTS = (
    "conv_id bigint, segment int, text string, stable boolean, "
    "turns array<struct<turn:int,role:string,start:bigint,end:bigint,text_start:bigint,text_end:bigint,loss:boolean>>"
)


def escape(text: str) -> str:
    """Put a backslash into every control string, one more where there are some already."""
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def instruct_template(turns: list[Turn]) -> str:
    """``<s>``, then the turns: users between [INST] and [/INST], assistants up to ``</s>``.

    Other roles are named between [ROLE] and [/ROLE] and end with [/TURN].
    """
    out = ["<s>"]
    for role, text in turns:
        if role == "user":
            out.append(f"[INST] {escape(text)} [/INST]")
        elif role == "assistant":
            out.append(f" {escape(text)}</s>")
        else:
            out.append(f"[ROLE]{escape(role)}[/ROLE]{escape(text)}[/TURN]")
    return "".join(out)


def role_at(segment: str, start: int, text_start: int) -> str:
    """The role that the instruct template has written between a turn's start and its text."""
    head = segment[start:text_start].removeprefix("<s>")
    if head.startswith("[INST]"):
        return "user"
    if head.startswith("[ROLE]"):
        return unescape(head[len("[ROLE]") : -len("[/ROLE]")])
    return "assistant"


def _shared(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def render(turns: list[Turn], template: Callable[[list[Turn]], str], loss_roles=("assistant",)) -> list[tuple[str, bool, list[dict]]]:
    """Segments (text, stable, turns) of a conversation; one, unless the template rewrites history.

    Each turn is in one segment, with its span there, the span of its text, and whether it is
    trained on. stable is false for segments that follow a rewriting. A template whose output
    for a turn doesn't hold the turn's text in one piece is an error.
    """
    segments: list[tuple[str, bool, list[dict]]] = []
    before, done, spans = "", [], []
    stable = True
    for k, (role, text) in enumerate(turns):
        whole = template([*done, (role, text)])
        none, marked = template([*done, (role, "")]), template([*done, (role, MARK)])
        if not whole.startswith(before):
            segments.append((before, stable, spans))
            spans, stable = [], False
            start = _shared(before, whole)
        else:
            start = len(before)
        at = _shared(none, marked)
        tail = len(none) - at
        if whole[:at] != none[:at] or not whole.endswith(none[at:]) or at + tail > len(whole):
            raise ValueError("the template doesn't write the text of a turn in one piece")
        spans.append(
            {
                "turn": k,
                "role": role,
                "start": min(start, at),
                "end": len(whole),
                "text_start": at,
                "text_end": len(whole) - tail,
                "loss": role in loss_roles,
            }
        )
        done.append((role, text))
        before = whole
    segments.append((before, stable, spans))
    return segments


def _conversations(batches):
    """(conv_id, turns) from rows sorted by conversation; only one is held at a time."""
    current, turns = None, []
    for batch in batches:
        for conv_id, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if turns and conv_id != current:
                yield current, turns
                turns = []
            current = conv_id
            turns.append((role, text))
    if turns:
        yield current, turns


def format_conversations(
    conversations: DataFrame, template: Callable[[list[Turn]], str] = instruct_template, loss_roles=("assistant",)
) -> DataFrame:
    """Segments of every conversation of (conv_id, turn, role, text), in code points.

    Turns stand in order of turn (null first), then role, then text; null roles and texts count as
    empty, and repeated rows are turns of their own. Rows with a null conv_id are one
    conversation. Other columns are ignored; an empty table gives no rows. Rows reach a task
    sorted, so that it holds one conversation at a time; calling the template on every prefix
    takes time with the square of a conversation's length.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    span = pa.struct(
        [("turn", pa.int32()), ("role", pa.string())]
        + [(c, pa.int64()) for c in ("start", "end", "text_start", "text_end")]
        + [("loss", pa.bool_())]
    )
    schema = pa.schema(
        [("conv_id", pa.int64()), ("segment", pa.int32()), ("text", pa.string()), ("stable", pa.bool_()), ("turns", pa.list_(span))]
    )

    def run(batches):
        out: list[tuple] = []
        held = 0
        for conv_id, turns in _conversations(batches):
            for k, (text, stable, spans) in enumerate(render(turns, template, loss_roles)):
                out.append((conv_id, k, text, stable, spans))
                held += len(text)
            if held > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return rows.mapInArrow(run, SEGMENTS)
