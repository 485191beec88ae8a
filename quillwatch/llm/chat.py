"""Chat formatting that is proved by reading it back.

Every turn is written between an opening and a closing line that name its role. A text may itself
hold such control strings. The rendered turn is therefore parsed again by the grammar; where the
parser does not return exactly what went in, the control strings inside the text are escaped with a
backslash after their first character (and those already looking escaped with one more), and the
result is parsed again. A turn that still differs is an error, so what is written can always be read.

    conversation = turn*
    turn  = "[INST]\\n" text "\\n[/INST]\\n"                          user
          | "<s>\\n" text "\\n</s>\\n"                                assistant
          | "<<SYS>>\\n" text "\\n<</SYS>>\\n"                        system
          | "<|role|>\\n" role "\\n<|text|>\\n" text "\\n<|/text|>\\n"  any other role

Only the text of assistant turns is under the loss mask. Turns follow the order of ``turn`` (null
last), then role, then text; a null role or text is empty; rows with a null conversation id form one
conversation. An empty table gives an empty result. Other columns are not read.

Turns are rendered one by one while Spark hands each task its conversations in order, so the memory
needed is that of one turn, however long a conversation is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The template.
FRAMES = {
    "user": ("[INST]\n", "\n[/INST]\n"),
    "assistant": ("<s>\n", "\n</s>\n"),
    "system": ("<<SYS>>\n", "\n<</SYS>>\n"),
}
ROLE, TEXT, END = "<|role|>\n", "\n<|text|>\n", "\n<|/text|>\n"
CONTROLS = ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<|role|>", "<|text|>", "<|/text|>")
LOSS_ROLE = "assistant"

_TAILS = "|".join(re.escape(c[1:]) for c in CONTROLS)
_CONTROL = re.compile(rf"([<\[])(\\*)({_TAILS})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)({_TAILS})")


class NotReadable(ValueError):
    """Text that the grammar does not derive."""


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def frame(role: str) -> tuple[str, str]:
    return FRAMES.get(role) or (ROLE + escape(role) + TEXT, END)


def _upto(formatted: str, at: int, end: str) -> int:
    """Where ``end`` begins, there being no other control string before it."""
    to = formatted.find(end, at)
    if to < 0:
        raise NotReadable(f"no {end.strip()} after {at}")
    inner = _CONTROL.search(formatted, at, to)
    while inner:
        if not inner[2]:
            raise NotReadable(f"{inner[0]} inside a text, at {inner.start()}")
        inner = _CONTROL.search(formatted, inner.end(), to)
    return to


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of every turn; start and end are where the text stands."""
    turns, at = [], 0
    while at < len(formatted):
        for role, (opening, closing) in FRAMES.items():
            if formatted.startswith(opening, at):
                start = at + len(opening)
                break
        else:
            if not formatted.startswith(ROLE, at):
                raise NotReadable(f"no turn begins at {at}")
            to = _upto(formatted, at + len(ROLE), TEXT)
            role, start, closing = unescape(formatted[at + len(ROLE) : to]), to + len(TEXT), END
        end = _upto(formatted, start, closing)
        turns.append((role, unescape(formatted[start:end]), start, end))
        at = end + len(closing)
    return turns


def render(role: str, text: str) -> str:
    """One turn in the template, escaped only where reading it back would not return the same turn."""
    opening, closing = frame(role)
    for inner in (text, escape(text)):
        formatted = opening + inner + closing
        try:
            turns = parse(formatted)
        except NotReadable:
            continue
        if [t[:2] for t in turns] == [(role, text)]:
            return formatted
    raise NotReadable(f"turn of role {role!r} cannot be rendered")


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 256).columns))


def _packed(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == 256:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def format_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted) per turn; each task holds whole conversations, their turns in order."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text")
    schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _packed(((conv, render(role, text)) for conv, role, text in _rows(batches)), schema)

    return rows.select("conv_id", "role", "text").mapInArrow(run, "conv_id long, formatted string")


def format_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans): a row per conversation, spans as (start, end) in code points."""
    schema = pa.schema([
        ("conv_id", pa.int64()), ("formatted", pa.string()),
        ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ])

    def whole(rows: Iterator[tuple]) -> Iterator[tuple]:
        current: object = rows  # no conversation yet
        texts: list[str] = []
        for conv, formatted in rows:
            if texts and conv != current:
                yield joined(current, texts)
                texts = []
            current = conv
            texts.append(formatted)
        if texts:
            yield joined(current, texts)

    def joined(conv, texts: list[str]) -> tuple:
        formatted = "".join(texts)
        spans = [{"start": s, "end": e} for role, _, s, e in parse(formatted) if role == LOSS_ROLE]
        return conv, formatted, spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _packed(whole(_rows(batches)), schema)

    return format_turns(conversations).mapInArrow(
        run, "conv_id long, formatted string, loss_spans array<struct<start: long, end: long>>"
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted turns of ``format_turns`` say, by conversation: number of turns, digests of all turns and
    of the text under the loss mask, and lengths in code points."""
    schema = pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ])

    def totals(rows: Iterator[tuple]) -> Iterator[tuple]:
        state = None
        for conv, text in rows:
            if state is None or conv != state[0]:
                if state:
                    yield done(state)
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[5] += len(text)
            for role, turn, start, end in parse(text):
                state[1] += 1
                state[2].update(f"{role}\n{turn}\n".encode())
                if role == LOSS_ROLE:
                    masked = unescape(text[start:end])
                    state[3] += len(masked)
                    state[4].update(masked.encode())
        if state:
            yield done(state)

    def done(state: list) -> tuple:
        conv, turns, all_turns, chars, loss, length = state
        return conv, turns, all_turns.hexdigest(), chars, loss.hexdigest(), length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _packed(totals(_rows(batches)), schema)

    return formatted.mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
