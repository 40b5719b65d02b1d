"""Chat formatting by incremental rendering of a black-box template.

A template is any function from a list of (role, text) to one string. The first k turns are
rendered for k = 1, 2, ...; what an output adds to the one before is the span of turn k. An output
that does not begin with the one before shows a template that rewrites history; it is reported and
the span is then what lies beyond the common part. Where the text itself lies inside its span is found the same way, from two
more renderings of the turn: with no text and with one sentinel character.

Turns of a conversation are read in order (turn, role, text) from a partition sorted on disk if
need be. A rendering takes all turns before, and its output is kept for the next one. Only where the
caller declares that a template looks back at so many turns at most, no more are kept, and a
conversation of any length is streamed. Defined results: NULL role and NULL text count as empty; a NULL conversation is
one more conversation; turns that repeat are turns of their own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

Template = Callable[[list[tuple[str, str]]], str]

# Turns of a rendering, the last included, that are enough for the default template; it looks back at none.
WINDOW = 64
SENTINEL = "␀"
START, END = "<|im_start|>", "<|im_end|>"

SPANS = {
    "conv_id": "string",
    "position": "bigint",
    "formatted": "string",
    "start": "bigint",
    "loss_start": "int",
    "loss_end": "int",
    "rewrites": "boolean",
}
READ = {
    "conv_id": "string",
    "n_turns": "bigint",
    "turns_sha256": "string",
    "loss_chars": "bigint",
    "loss_sha256": "string",
    "formatted_chars": "bigint",
    "rewrites": "boolean",
}

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No ``<|`` is left: one backslash more between the two characters."""
    return _CONTROL.sub(r"<\\\1|", text) if "|" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "|" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def marked_turns(messages: list[tuple[str, str]]) -> str:
    """The default template: each turn between marks, control strings in it escaped."""
    return "".join(f"{START}{escape_role(role)}\n{escape(text)}{END}\n" for role, text in messages)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of what :func:`marked_turns` rendered."""
    out = []
    for turn in formatted.split(START)[1:]:
        head, _, rest = turn.partition("\n")
        if not rest.endswith(END + "\n"):
            raise ValueError("a turn without its end mark")
        out.append((unescape_role(head), unescape(rest[: -len(END) - 1])))
    return out


def _common(a: str, b: str) -> int:
    return len(os.path.commonprefix([a, b]))


def add_turn(
    template: Template, before: list[tuple[str, str]], turn: tuple[str, str], base: str | None = None, whole: str | None = None
) -> tuple[str, int, int, bool]:
    """What ``turn`` adds to the output, where its text lies in that, and whether history changed.

    ``base`` and ``whole`` are the output without and with the turn, where they are known.
    """
    if base is None:
        base = template(before) if before else ""
    if whole is None:
        whole = template([*before, turn])
    kept = len(base) if whole.startswith(base) else _common(base, whole)
    span = whole[kept:]
    empty = template([*before, (turn[0], "")])
    probe = template([*before, (turn[0], SENTINEL)])
    head = _common(empty, probe)
    tail = len(empty) - head
    fixed = empty[:head] == whole[:head] and whole.endswith(empty[head:]) and head >= kept and len(whole) >= len(empty)
    if fixed:
        return span, head - kept, len(span) - tail, kept < len(base)
    # The surroundings depend on the text: it is where the sentinel's neighbours are no longer common.
    return span, max(0, head - kept), max(max(0, head - kept), len(span) - tail), True


def format_conversations(
    turns: DataFrame,
    template: Template = marked_turns,
    loss_roles: tuple[str, ...] = ("assistant",),
    conv: str = "conv_id",
    turn: str = "turn",
    look_back: int | None = None,
) -> DataFrame:
    """One row per turn, in order inside its partition.

    ``look_back`` declares that a turn's rendering depends on so many turns before it at most; by
    default it may depend on all of them, and all are rendered.

    ``position`` counts a conversation's turns from 0; ``formatted`` is what the turn adds to the
    output, from character ``start`` of it; ``loss_start`` and ``loss_end`` bound the text under
    the loss mask inside ``formatted`` (NULL: none); ``rewrites`` tells of changed history.
    """
    # As a string: whole numbers beside NULLs would become floats in pandas.
    kind = turns.schema[conv].dataType
    narrow = turns.select(F.col(conv).cast("string").alias("conv_id"), F.col(turn).alias("turn"), "role", "text")
    ordered = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = ", ".join(map(" ".join, SPANS.items()))

    def render(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, position, at = object(), 0, 0
        recent: deque[tuple[str, str]] = deque(maxlen=look_back)
        last: str | None = None
        for frame in frames:
            out = []
            for key, role, text in zip(frame["conv_id"], frame["role"].fillna(""), frame["text"].fillna("")):
                if key != current:
                    current, position, at = key, 0, 0
                    recent.clear()
                    last = ""
                before = list(recent)
                whole = template([*before, (role, text)])
                span, lo, hi, rewrites = add_turn(template, before, (role, text), last, whole)
                # Under a window the next rendering begins with another turn.
                last = whole if look_back is None else None
                masked = (lo, hi) if role in loss_roles else (None, None)
                out.append((key, position, span, at, *masked, rewrites))
                recent.append((role, text))
                position, at = position + 1, at + len(span)
            yield pd.DataFrame(out, columns=list(SPANS), dtype=object)

    spans = ordered.mapInPandas(render, schema)
    return spans.withColumn("conv_id", F.col("conv_id").cast(kind))


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation from the turns of :func:`format_conversations`, in the order it left them.

    Roles and texts are parsed from the output itself, the masked text is cut from it by its span;
    digests grow turn by turn, so no conversation is held.
    """
    kind = formatted.schema["conv_id"].dataType
    spans = formatted.withColumn("conv_id", F.col("conv_id").cast("string"))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = None
        state: list | None = None

        def row() -> tuple:
            n, turns, chars, loss, length, rewrites = state
            return key, n, turns.hexdigest(), chars, loss.hexdigest(), length, rewrites

        for frame in frames:
            done = []
            for conv, start, text, lo, hi, rewrites in zip(
                frame["conv_id"], frame["start"], frame["formatted"], frame["loss_start"], frame["loss_end"], frame["rewrites"]
            ):
                if start == 0:
                    if state is not None:
                        done.append(row())
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, False]
                for role, said in parse_turns(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                if pd.notna(lo):
                    masked = unescape(text[int(lo) : int(hi)])
                    state[2] += len(masked)
                    state[3].update(masked.encode())
                state[4] += len(text)
                state[5] |= bool(rewrites)
            yield pd.DataFrame(done, columns=list(READ), dtype=object)
        if state is not None:
            yield pd.DataFrame([row()], columns=list(READ), dtype=object)

    rows = spans.mapInPandas(read, ", ".join(map(" ".join, READ.items())))
    return rows.withColumn("conv_id", F.col("conv_id").cast(kind))
