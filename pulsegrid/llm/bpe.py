"""BPE encoding and decoding of whole texts with tree concatenation.

Texts up to ``PIECE`` code points are encoded where they are read. A longer text is cut into pieces that are encoded in
parallel tasks; then neighbours are joined pairwise, level by level. A join re-encodes a window around the cut: as long
as its first and last tokens differ from those of either side, the window grows, up to both whole sides. Tokens that
stand next to each other in a right encoding are right next to each other everywhere, so a window whose ends agree with
both sides makes the joined tokens exact.

The fast encoder takes its vocabulary from the tokenizer's file; texts with characters outside the common Latin ranges
go through the tokenizer itself, so differences between Unicode tables cannot show.

Defined cases: null and empty texts have no tokens and decode to empty text; control strings of the tokenizer in a text
become their ids, as the tokenizer does; repeated rows and rows without doc_id are encoded like others; other columns are
not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.shared import kept, ship
from pulsegrid.llm.words import pieces

PIECE = 16_384
#: Tokens on either side of a cut in the first window, and those that must agree at its ends.
MARGIN, AGREE = 32, 8
# The split pattern of this family of tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters on which all Unicode tables agree.
_UNCOMMON = re.compile("[^\t\n\r\x20-\x7e¡-ſ‐-‧]")

_coders: dict[str, Coder] = {}


class Coder:
    """Encodes and decodes with the vocabulary of a byte-level tokenizer file."""

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.no_truncation()
        self.slow.no_padding()
        with open(path, encoding="utf-8") as handle:
            described = json.load(handle)
        vocabulary = described["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        # Byte-level files write a byte as a printable character: itself, or the next free one from 256 on.
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(printable)]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
        ranks = {bytes(byte_of[c] for c in token): number for token, number in vocabulary.items() if token not in self.special}
        self.bytes = [b""] * (max([*vocabulary.values(), *self.special.values()]) + 1)
        for token, number in ranks.items():
            self.bytes[number] = token
        for token, number in self.special.items():
            self.bytes[number] = token.encode()
        self.lengths = np.array([len(b) for b in self.bytes])
        # The fast encoder merges by rank of the result; that is this file's rule if ids follow the order of the merges.
        order = [ranks[bytes(byte_of[c] for c in "".join(pair))] for pair in (m.split(" ") if isinstance(m, str) else m for m in described["model"]["merges"])]
        self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special) if order == sorted(order) else None

    def encode(self, text: str) -> list[int]:
        if self.fast is None or _UNCOMMON.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode(text, allowed_special="all")

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


def coder(path: str) -> Coder:
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def joined(code: Coder, data: bytes, left: list[int], right: list[int], start: int, cut: int) -> list[int]:
    """The tokens of ``data`` from ``start``: ``left`` ends and ``right`` begins at ``cut``."""
    behind, ahead = np.cumsum(code.lengths[left[::-1]]), np.cumsum(code.lengths[right])
    end, margin = cut + (int(ahead[-1]) if len(ahead) else 0), MARGIN
    while True:
        a, b = min(margin, len(left)), min(margin, len(right))
        # A window starts and ends between characters.
        while 0 < a < len(left) and data[cut - behind[a - 1]] & 0xC0 == 0x80:
            a += 1
        while 0 < b < len(right) and data[cut + ahead[b - 1]] & 0xC0 == 0x80:
            b += 1
        begin, stop = cut - (int(behind[a - 1]) if a else 0), cut + (int(ahead[b - 1]) if b else 0)
        middle = code.encode(data[begin:stop].decode())
        if (begin == start or middle[:AGREE] == left[len(left) - a:][:AGREE]) and (stop == end or middle[-AGREE:] == right[:b][-AGREE:]):
            return left[:len(left) - a] + middle + right[b:]
        margin *= 2


def tree(code: Coder, text: str, parts: list[tuple[int, list[int]]]) -> list[int]:
    """Joins the parts (code points, tokens) of a text level by level."""
    data = text.encode()
    at, offsets, level = 0, [], [ids for _, ids in parts]
    for size, _ in parts:
        offsets.append(len(text[:at].encode()) if at < 1 << 16 else offsets[-1] + len(text[at - parts[len(offsets) - 1][0]:at].encode()))
        at += size
    while len(level) > 1:
        pairs = [(joined(code, data, level[i], level[i + 1], offsets[i], offsets[i + 1]) if i + 1 < len(level) else level[i]) for i in range(0, len(level), 2)]
        level, offsets = pairs, offsets[::2]
    return level[0] if level else []


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def _short(path: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        for piece in pieces(batches):
            ids = [code.encode(text or "") for text in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()), pa.array([_packed(x) for x in ids], pa.binary())],
                names=["doc_id", "n_tokens", "ids"])
    return run


def _split(size: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for batch in pieces(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                cuts = range(0, len(text), size)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * len(cuts), pa.int32()), pa.array([row] * len(cuts), pa.int64()), pa.array([doc_id] * len(cuts), pa.int64()),
                    pa.array(range(len(cuts)), pa.int32()), pa.array([text[i:i + size] for i in cuts])],
                    names=["part", "row", "doc_id", "number", "text"])
                row += 1
    return run


def _encoded_pieces(path: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        for piece in pieces(batches):
            ids = [_packed(code.encode(text)) for text in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(ids, pa.binary())], names=[*piece.schema.names, "ids"])
    return run


def _trees(path: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        for batch in pieces(batches, ("size_hint",)):
            for doc_id, parts in zip(batch.column("doc_id").to_pylist(), batch.column("parts").to_pylist(), strict=True):
                parts.sort(key=lambda p: p["number"])
                ids = tree(code, "".join(p["text"] for p in parts), [(len(p["text"]), np.frombuffer(p["ids"], "<u4").tolist()) for p in parts])
                yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([_packed(ids)], pa.binary())],
                                                 names=["doc_id", "n_tokens", "ids"])
    return run


def encoded(docs: DataFrame, path: str, piece: int = PIECE) -> DataFrame:
    """(doc_id, n_tokens, ids): ids as little-endian 32-bit numbers. ``path`` names the tokenizer's file on every machine."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = F.coalesce(F.length("text"), F.lit(0))
    short = docs.filter(size <= piece).mapInArrow(_short(path), "doc_id long, n_tokens long, ids binary")
    cut = kept(docs.filter(size > piece).mapInArrow(_split(piece), "part int, row long, doc_id long, number int, text string"), "bpe-pieces")
    coded = cut.repartition("part", "row", "number").mapInArrow(
        _encoded_pieces(path), "part int, row long, doc_id long, number int, text string, ids binary")
    # One row per long text: its digest needs all of its tokens in order.
    whole = coded.groupBy("part", "row", "doc_id").agg(F.collect_list(F.struct("number", "text", "ids")).alias("parts"))
    long = whole.select("doc_id", "parts", F.lit("").alias("size_hint")).mapInArrow(_trees(path), "doc_id long, n_tokens long, ids binary")
    return short.unionByName(long)


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """The rows of ``encoded`` with column ``text``: the decoded ids, control strings included."""
    ship(rows.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        for piece in pieces(batches, ("ids",)):
            texts = [code.decode(np.frombuffer(b.as_buffer(), "<u4")) for b in piece.column("ids")]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(texts, pa.string())], names=[*piece.schema.names, "text"])
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary, text string")
