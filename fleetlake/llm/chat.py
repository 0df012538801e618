"""Chat formatting with a black-box template: spans of turns, loss mask, detection of rewritten history.

The template is any function from turns ``[(role, text), ...]`` to a string.
Each turn's part of the output is found by rendering successive prefixes: what
``render(turns[:i + 1])`` has beyond ``render(turns[:i])`` is turn ``i``.  If
the longer output does not begin with the shorter one, the template has
rewritten what it had already said; the turn is marked ``rewrites`` and its
part begins where the two outputs part.  Where a turn's text stands inside its
part is found by rendering it once more with a probe character as its text.

The prefix is the whole conversation before the turn, as a template may look back
as far as it likes; a conversation costs the square of its length.  ``context``
bounds the prefix to that many turns before the turn, so the work is linear.  It
is for templates that look no further back: the pieces joined are compared with
one rendering of the whole conversation, and a difference is an error.

``chatml`` marks turns with control strings and escapes these in texts and roles,
reversibly; ``read_back`` parses its joined output.

Turns are taken by ``turn``, then role and text (nulls first).  Null texts and
roles are empty; rows with a null conv_id are left out; repeated rows are turns
of their own.  Further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches

Turns = list[tuple[str, str]]
# The template's control strings.
START, END = "<|im_start|>", "<|im_end|>"
PROBE = "\x01"


def escape(text: str) -> str:
    """No ``<|`` is left: one more backslash goes between ``<`` and ``|``."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def chatml(turns: Turns) -> str:
    return "".join(f"{START}{quote(role, safe=' ')}\n{escape(text)}{END}\n" for role, text in turns)


def split(joined: str) -> Iterator[tuple[str, str, int]]:
    """Role, text and end of every whole turn at the start of ``chatml``'s output, found by its control strings
    alone; what follows the last one is an unfinished turn, or nothing."""
    at = 0
    while at < len(joined):
        if not joined.startswith(START, at):
            if START.startswith(joined[at:]):
                return
            raise ValueError(f"no turn begins at: {joined[at:at + 80]!r}")
        line = joined.find("\n", at)
        stop = joined.find("<|", line + 1) if line >= 0 else -1
        if stop < 0:
            return
        close = END + "\n"
        if not joined.startswith(close, stop):
            if close.startswith(joined[stop:]):
                return
            raise ValueError(f"a turn does not end at: {joined[stop:stop + 80]!r}")
        yield unquote(joined[at + len(START):line]), unescape(joined[line + 1:stop]), (at := stop + len(close))


def common(a: str, b: str) -> int:
    """Length of the common prefix."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def turn_part(render: Callable[[Turns], str], before: Turns, role: str, text: str,
              shorter: str | None = None) -> tuple[str, int, int, bool, str]:
    """What the turn adds after ``before``: its part, the start and end of its text there, whether the template
    rewrote history, and the output with the turn.  ``shorter`` is the output before it, if that is known."""
    if shorter is None:
        shorter = render(before) if before else ""
    longer = render([*before, (role, text)])
    cut = common(shorter, longer)
    rewrites = cut < len(shorter)
    empty = render([*before, (role, "")])
    head = common(empty, render([*before, (role, PROBE)]))
    start = max(head, cut) - cut
    end = max(start, start + len(longer) - len(empty))
    return longer[cut:], start, min(end, len(longer) - cut), rewrites, longer


def format_turns(conversations: DataFrame, render: Callable[[Turns], str] = chatml, context: int | None = None,
                 loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``conversations(conv_id, turn, role, text)`` -> a row per turn in the conversation's order: conv_id,
    place, piece (the turn's part of the output; the pieces joined are the output), offset of the piece,
    loss_start and loss_end of the text under the loss mask within it (null: none), rewrites."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        names = ["conv_id", "place", "piece", "offset", "loss_start", "loss_end", "rewrites"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
        conv, before, place, offset, last = None, [], 0, 0, None
        every, said = [], []  # of a bounded prefix: the conversation's turns and pieces

        def settle():
            if context is not None and every and "".join(said) != render(every):
                raise ValueError(f"conversation {conv}: the template looks back further than context={context}, "
                                 "or rewrites; use context=None")

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = []
                for key, role, text in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns), strict=True):
                    if key != conv:
                        settle()
                        conv, before, place, offset, last, every, said = key, [], 0, 0, None, [], []
                    piece, start, end, rewrites, last = turn_part(render, before, role, text, last)
                    loss = (start, end) if role in loss_roles else (None, None)
                    rows.append((conv, place, piece, offset, *loss, rewrites))
                    before.append((role, text))
                    if context is not None:
                        before, last = before[max(0, len(before) - context):], None
                        every.append((role, text))
                        said.append(piece)
                    place, offset = place + 1, offset + len(piece)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                                 names)
        settle()

    turns = (conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))
    return turns.select("conv_id", "role", "text").transform(in_batches, run, "conv_id long, place long, piece string, offset long, loss_start int, loss_end int, rewrites boolean")


def read_back(formatted: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``format_turns``' rows, as they come, -> a row per conversation: n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, n_rewrites.

    The pieces are joined again, and turns, roles and the text under the loss
    mask are taken from the control strings found in that output alone, turn by
    turn as it comes; where ``format_turns`` cut it plays no part.  Output that
    is not whole turns is an error.  Where the mask that ``format_turns`` stated
    covers other characters than the turns of ``loss_roles`` found, that is an error too.
    """

    def run(batches) -> Iterator:
        from hashlib import sha256

        import pyarrow as pa

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_rewrites"]
        conv, now, rest, masked = None, None, "", None

        def ended():
            if rest:
                raise ValueError(f"conversation {conv} ends inside a turn: {rest[:80]!r}")
            if masked.digest() != now[3].digest():
                raise ValueError(f"conversation {conv}: the loss mask does not cover the turns of {loss_roles}")

        def row(rows):
            done = [(c, x[0], x[1].hexdigest(), x[2], x[3].hexdigest(), x[4], x[5]) for c, x in rows]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names)

        for batch in batches:
            rows = []
            for key, piece, start, end, rewrites in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != conv:
                    if now:
                        rows.append((conv, now))
                        ended()
                    conv, now, rest, masked = key, [0, sha256(), 0, sha256(), 0, 0], "", sha256()
                rest, done = rest + piece, 0
                for role, text, done in split(rest):
                    now[0] += 1
                    now[1].update(f"{role}\n{text}\n".encode())
                    if role in loss_roles:
                        now[2] += len(text)
                        now[3].update(text.encode())
                rest = rest[done:]
                if start is not None:
                    masked.update(unescape(piece[start:end]).encode())
                now[4] += len(piece)
                now[5] += rewrites
            if rows:
                yield row(rows)
        if now:
            ended()
            yield row([(conv, now)])

    return formatted.select("conv_id", "piece", "loss_start", "loss_end", "rewrites").transform(in_batches, run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long, n_rewrites long")
