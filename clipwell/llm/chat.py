r"""Chat formatting with a grammar round trip.

A conversation is rendered turn by turn as

    ### role: text</turn>

with a line break after each turn. The grammar of the rendered text is
deterministic: ``\\``, ``\</turn>`` and ``\### `` are escapes, any other
backslash is itself, an unescaped ``</turn>`` ends a turn, and an unescaped
``### `` must not begin a line inside one. Every rendered turn is parsed again
and compared to its source; where they differ, its text is escaped further until
they are identical: as it is, then the control strings, then all backslashes as
well, which always succeeds. Turns are self-delimiting, so the parts of a
conversation parse like the whole. The loss mask is a list of spans, one for the
text of each assistant turn.

A conversation goes through one task in order of its turns, as a stream: it is
cut into parts of about ``PART_CHARS`` code points (one turn is never cut), so
memory stays bounded however many turns it has.

Null texts and roles are empty, a null id is one conversation, null turns come
first; equal turn numbers follow role and text; repeated rows are repeated
turns. An empty table gives no rows, other columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART_CHARS = 1 << 20
LOSS_ROLE = "assistant"
#: Begin and end of a turn.
OPEN, CLOSE = "### ", "</turn>"
_HEAD = re.compile(r"### ((?:[^\\:\n]|\\[\\:n])*+): ")
_ROLE_ESCAPE = re.compile(r"\\([\\:n])")
_ESCAPE = re.compile(r"\\(\\|</turn>|### )")
_STOP = re.compile(r"\\(?:\\|</turn>|### )|</turn>|\n### ")

PARTS = "conv_id string, part bigint, text string, loss array<struct<start: bigint, end: bigint>>"
READ = "conv_id string, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def unescaped(body: str) -> str:
    return _ESCAPE.sub(lambda m: m[1], body) if "\\" in body else body


def parse(text: str) -> list[tuple[str, str, int, int]] | None:
    """(role, text, start and end of the written text) of every turn; None if it is not in the grammar."""
    turns, at = [], 0
    while at < len(text):
        head = _HEAD.match(text, at)
        if not head or text.startswith(OPEN, head.end()):
            return None
        stop = next((m for m in _STOP.finditer(text, head.end()) if m[0][0] != "\\"), None)
        if not stop or stop[0] != CLOSE or text[stop.end() : stop.end() + 1] != "\n":
            return None
        role = _ROLE_ESCAPE.sub(lambda m: "\n" if m[1] == "n" else m[1], head[1])
        turns.append((role, unescaped(text[head.end() : stop.start()]), head.end(), stop.start()))
        at = stop.end() + 1
    return turns


def _escaped(text: str) -> Iterator[str]:
    yield text
    for t in (text, text.replace("\\", "\\\\")):
        yield t.replace(CLOSE, "\\" + CLOSE).replace(OPEN, "\\" + OPEN)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn that parses to its source, and the span of its text."""
    head = OPEN + role.replace("\\", "\\\\").replace(":", "\\:").replace("\n", "\\n") + ": "
    for body in _escaped(text):
        out = f"{head}{body}{CLOSE}\n"
        if (back := parse(out)) and [x[:2] for x in back] == [(role, text)]:
            return out, len(head), len(head) + len(body)
    raise AssertionError("a fully escaped turn did not parse to its source")


def _format(frames: Iterator[pd.DataFrame], part_chars: int) -> Iterator[pd.DataFrame]:
    conv, part, written, chars, loss, rows = None, 0, [], 0, [], []

    def end() -> None:
        nonlocal part, written, chars, loss
        if written:
            rows.append((conv, part, "".join(written), loss))
            part, written, chars, loss = part + 1, [], 0, []

    for f in frames:
        for c, role, text in zip(f.conv_id, f.role, f.text):
            if c != conv:
                end()
                conv, part = c, 0
            turn, start, stop = render(role, text)
            if written and chars + len(turn) > part_chars:
                end()
            if role == LOSS_ROLE:
                loss.append({"start": chars + start, "end": chars + stop})
            written.append(turn)
            chars += len(turn)
            if len(rows) >= 256 or rows and chars >= part_chars:
                yield _frame(rows, PARTS)
                rows = []
    end()
    yield _frame(rows, PARTS)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.replace("struct<start: bigint, end: bigint>", "s").split(", ")])


def formatted(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", part_chars: int = PART_CHARS
) -> DataFrame:
    """Conversations as rendered parts: conv_id, part (from 0), text, spans of the loss mask in the part."""
    empty = F.lit("")
    rows = turns.select(
        F.col(f"`{conv}`").cast("string").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), empty).alias("role"), F.coalesce(F.col(f"`{text}`"), empty).alias("text"),
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    parts = dealt.select("conv_id", "role", "text").mapInPandas(lambda frames: _format(frames, part_chars), PARTS)
    return parts.withColumn("conv_id", F.col("conv_id").cast(turns.schema[conv].dataType))


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    conv, open_, rows = None, False, []
    n = chars = loss_chars = 0
    whole, masked = sha256(), sha256()

    def end() -> None:
        if open_:
            rows.append((conv, n, whole.hexdigest(), loss_chars, masked.hexdigest(), chars))

    for f in frames:
        for c, text, loss in zip(f.conv_id, f.text, f.loss):
            if c != conv or not open_:
                end()
                conv, open_, n, chars, loss_chars, whole, masked = c, True, 0, 0, 0, sha256(), sha256()
            back = parse(text)
            if back is None:
                raise ValueError(f"conversation {c} is not in the grammar")
            for role, t, _, _ in back:
                whole.update(f"{role}\n{t}\n".encode())
            for span in loss:
                t = unescaped(text[span["start"] : span["end"]])
                loss_chars += len(t)
                masked.update(t.encode())
            n, chars = n + len(back), chars + len(text)
        yield _frame(rows, READ)
        rows = []
    end()
    yield _frame(rows, READ)


def read_back(parts: DataFrame) -> DataFrame:
    """Parse rendered parts: turns, digest of roles and texts, length and digest of the text under the loss mask, all code points."""
    kind = parts.schema["conv_id"].dataType
    rows = parts.withColumn("conv_id", F.col("conv_id").cast("string"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return dealt.mapInPandas(_read, READ).withColumn("conv_id", F.col("conv_id").cast(kind))
