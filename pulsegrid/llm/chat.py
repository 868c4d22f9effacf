"""Chat formatting with a grammar round trip.

A conversation is rendered as turns ``<|im_start|>role\\ntext<|im_end|>\\n``. Every turn is first rendered plainly and read
by the deterministic parser below; a turn that does not come back identical is escaped, and the whole conversation is
parsed again and compared with its source, with every turn escaped if it still differed. Escaping adds a backslash to
each ``<`` + backslashes + ``|`` (``<|`` becomes ``<\\|``), and in roles a line feed is written ``<|lf|>``; the parser takes
one backslash away, so a text that already holds ``<\\|`` conflicts as well and is escaped too.

Defined cases: null text and null role are empty; turns are ordered by turn (null first), then role and text, so ties and
repeated rows have a fixed order; rows without conv_id form one conversation; no rows give no conversations; other
columns are not read. A conversation is one value: all of its turns meet in one row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.shared import ship
from pulsegrid.llm.words import pieces

START, END, LINE = "<|im_start|>", "<|im_end|>\n", "<|lf|>"
_MARK, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")

Turn = tuple[str, str]


def escape(text: str) -> str:
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def render(turn: Turn, escaped: bool) -> tuple[str, int, int]:
    """The turn as text, and the bounds of its content."""
    role, text = turn
    role = (escape(role) if escaped else role).replace("\n", LINE)
    head = f"{START}{role}\n"
    body = escape(text) if escaped else text
    return f"{head}{body}{END}", len(head), len(head) + len(body)


def parse(rendered: str) -> list[Turn] | None:
    """The turns of a rendered conversation, or None if it is not one."""
    turns, at = [], 0
    while at < len(rendered):
        line = rendered.find("\n", at)
        stop = rendered.find(END, line + 1)
        if not rendered.startswith(START, at) or line < 0 or stop < 0:
            return None
        role, text = rendered[at + len(START):line], rendered[line + 1:stop]
        if START in text or START in role or END[:-1] in text:
            return None
        turns.append((unescape(role.replace(LINE, "\n")), unescape(text)))
        at = stop + len(END)
    return turns


def formatted(turns: list[Turn]) -> tuple[str, list[tuple[int, int]]]:
    """The rendered conversation and the spans of its assistant texts, the loss mask."""
    escaped = [parse(render(turn, False)[0]) != [turn] for turn in turns]
    while True:
        parts, spans, at = [], [], 0
        for turn, flag in zip(turns, escaped, strict=True):
            text, a, b = render(turn, flag)
            if turn[0] == "assistant":
                spans.append((at + a, at + b))
            parts.append(text)
            at += len(text)
        whole = "".join(parts)
        if parse(whole) == turns or all(escaped):
            return whole, spans
        escaped = [True] * len(turns)


def _rendered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, ("size_hint",), 1 << 8):
        texts, masks = [], []
        for turns in batch.column("turns").to_pylist():
            whole, spans = formatted([(t["role"], t["text"]) for t in turns])
            texts.append(whole)
            masks.append([{"begin": a, "end": b} for a, b in spans])
        yield pa.RecordBatch.from_arrays([
            batch.column("conv_id"), pa.array(texts, pa.string()),
            pa.array(masks, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))], names=["conv_id", "formatted", "loss_mask"])


def rendered_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_mask): spans of code points of assistant texts within the formatted text."""
    ship(turns.sparkSession)
    row = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = turns.select(F.col("conv_id").cast("long").alias("conv_id"), row.alias("row")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("row")).alias("turns"))
    return whole.select("conv_id", "turns", F.lit("").alias("size_hint")).mapInArrow(
        _rendered, "conv_id long, formatted string, loss_mask array<struct<begin:long,end:long>>")


def _read_back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, ("formatted",)):
        rows = []
        for conv, text, mask in zip(batch.column("conv_id").to_pylist(), batch.column("formatted").to_pylist(), batch.column("loss_mask").to_pylist(), strict=True):
            turns = parse(text)
            said = hashlib.sha256()
            for role, content in turns:
                said.update(f"{role}\n{content}\n".encode())
            loss = "".join(unescape(text[span["begin"]:span["end"]]) for span in mask)
            rows.append((conv, len(turns), said.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)


def read_back(rendered: DataFrame) -> DataFrame:
    """Digests of what the parser recovers from the formatted texts."""
    ship(rendered.sparkSession)
    return rendered.mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
