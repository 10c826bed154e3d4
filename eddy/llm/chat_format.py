"""Conversations rendered as training text that parses back to them.

A turn is rendered as ``<s>[INST]role[/INST]text</s>``; the turns of a
conversation in order, one after another, are its formatted text.  A
deterministic parser reads roles and texts back.  A role or text that
holds one of the four control strings, or the escape sign, does not come
back as it was: it is escaped, and parsed again, until all of the turn is
identical.  The escape is reversible: a sign is doubled, and a control
string gets a sign behind its first character, so that only the template
itself has control strings.  (A control string has its opening character
only in front and its closing one only at the end, so none arises where
the template and a text meet.)

The loss mask of a turn spans an assistant's text in the formatted turn.

Turns are rendered and checked apart from each other, in any task.  To
read conversations back, turns are dealt out by conversation and sorted;
a task then reads the formatted turns as a stream and holds one turn at a
time, however long a conversation is.  (A digest over a conversation is
one chain: its turns must pass through one task, but only as formatted
turns that are already checked.)

Defined cases: a null role or text counts as empty; turns sort by turn
(null first), then role, then text; repeated rows are turns of their own;
rows with a null conv_id are one conversation; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGN = "␛"
BEGIN, ROLE_END, END = "<s>[INST]", "[/INST]", "</s>"
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
ASSISTANT = "assistant"

_CONFLICT = re.compile("|".join(map(re.escape, (SIGN, *CONTROLS))))
_SIGNS = re.compile(f"{SIGN}({SIGN}?)")
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))


def escape(text: str) -> str:
    return _CONFLICT.sub(lambda m: m[0][0] + SIGN + m[0][1:], text)


def unescape(text: str) -> str:
    return _SIGNS.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn and its loss span (empty for other roles)."""
    head = BEGIN + role + ROLE_END
    span = (len(head), len(head) + len(text)) if unescape(role) == ASSISTANT else (0, 0)
    return (head + text + END, *span)


class ParseError(ValueError):
    pass


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of formatted text."""
    turns, at = [], 0
    while at < len(formatted):
        fields = []
        for mark, close in ((BEGIN, "[/INST]"), (None, "</s>")):
            if mark and not formatted.startswith(mark, at):
                raise ParseError(f"no turn begins at {at}")
            at += len(mark or "")
            m = _CONTROL.search(formatted, at)
            if not m or m[0] != close:
                raise ParseError(f"{close} is missing after {at}")
            fields.append(unescape(formatted[at:m.start()]))
            at = m.end()
        turns.append(tuple(fields))
    return turns


def _comes_back(role: str, text: str, as_role: str, as_text: str) -> bool:
    try:
        return parse(render(as_role, as_text)[0]) == [(role, text)]
    except ParseError:
        return False


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """Render a turn, escaping what does not come back, until all does."""
    if not _comes_back(role, text, role, text):
        parts = [role, text]
        for i, part in enumerate((role, text)):
            # the field alone, so that only what conflicts is escaped
            if not _comes_back(*((part, "") if i == 0 else ("", part)) * 2):
                parts[i] = escape(part)
        if not _comes_back(role, text, *parts):
            raise ParseError("a turn does not come back")
        return render(*parts)
    return render(role, text)


_FORMATTED = "conv_id bigint, turn bigint, role string, text string, formatted string, loss_start bigint, loss_end bigint"


def _format(batches):
    for batch in batches:
        rows = [format_turn(r, t) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
        formatted, start, end = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("conv_id", "turn", "role", "text")), pa.array(formatted, pa.string()),
             pa.array(start, pa.int64()), pa.array(end, pa.int64())],
            names=["conv_id", "turn", "role", "text", "formatted", "loss_start", "loss_end"])


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, formatted, loss_start, loss_end) for each turn."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), text("role"), text("text"))
    return rows.mapInArrow(_format, _FORMATTED)


_READ = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


class _Conversation:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n, self.loss_chars, self.chars = 0, 0, 0

    def read(self, formatted: str, start: int, end: int) -> None:
        for role, text in parse(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n += 1
        masked = unescape(formatted[start:end])
        self.loss.update(masked.encode())
        self.loss_chars += len(masked)
        self.chars += len(formatted)

    def row(self, conv_id):
        return conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read(batches):
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = [f.split()[0] for f in _READ.split(", ")]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    current, conversation, done = None, None, []
    for batch in batches:
        for conv_id, formatted, start, end in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end"))):
            if conversation is None or conv_id != current:
                if conversation is not None:
                    done.append(conversation.row(current))
                current, conversation = conv_id, _Conversation()
            conversation.read(formatted, start, end)
        if done:
            yield batch_of(done)
            done = []
    if conversation is not None:
        yield batch_of([conversation.row(current)])


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, parsed from its formatted turns."""
    order = ["conv_id", "turn", "role", "text"]
    rows = formatted.repartition("conv_id").sortWithinPartitions(*order)
    return rows.select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(_read, _READ)


def read_back_sql(extra: str) -> str:
    """The same in DuckDB SQL; ``extra`` is a row source to add to the table."""
    conflict = "|".join(re.sub(r"([\[\]])", r"\\\1", c) for c in (SIGN, *CONTROLS))
    size = lambda c: f"length({c}) + len(regexp_extract_all({c}, '{conflict}'))"
    return f"""with turns as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
        from (select conv_id, turn, role, text from conversations union all {extra}))
      select conv_id, count(*) as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
        coalesce(sum(length(text)) filter (role = '{ASSISTANT}'), 0)::bigint as loss_chars,
        sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = '{ASSISTANT}'), '')) as loss_sha256,
        sum({len(BEGIN) + len(ROLE_END) + len(END)} + {size('role')} + {size('text')})::bigint as formatted_chars
      from turns group by conv_id"""
