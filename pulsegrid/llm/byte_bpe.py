"""Byte-level BPE over a file of ranks, by backtracking from longest matches.

The bytes of a word are written as Latin-1 characters, so that one automaton of all tokens finds every token in it in one
pass; kept is the longest token that starts at each byte. From left to right the longest token is taken that is compatible
with the token before it; where none is, the last token is taken back, its end is closed for good, and the next shorter
token is tried. Every byte is closed at most once, so the work is linear in the word.

Two adjacent tokens are compatible if merging by rank keeps the cut between them. The merges of each token happen in the
order of their ranks, so only the parts next to the cut matter: the right edge of the first token and the left edge of the
second grow step by step, and the cut falls if the token over it ranks before the next step of either edge (at equal ranks
the leftmost merge is first). Answers are remembered. The first merge over a cut of a whole encoding would also happen
with its two tokens alone, so a sequence of pairwise compatible tokens is exactly the encoding.

Texts are cut by ``pattern`` first; a match that is a token itself is that token. Letters and numbers that are newer than
the Unicode tables of tiktoken count as other characters, as they do there. Ids of words are remembered by the worker up to a
fixed number; longer words are encoded each time.

Defined cases: null and empty texts have no tokens and decode to no bytes; control strings are plain text; repeated rows and
rows without doc_id are encoded like others; an empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import base64
import re
import struct
import sys
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.shared import ship
from pulsegrid.llm.words import pieces

#: Words and pairs that a worker remembers, the longest such word, and the longest text whose words are listed at once.
REMEMBERED, REMEMBERED_CHARS, LISTED_CHARS = 600_000, 64, 1 << 20
NEVER = 1 << 62

_coders: dict[tuple[str, str], Coder] = {}


def newer_characters() -> list[str]:
    """Letters and numbers to the module regex that tiktoken does not know as such yet."""
    import regex
    import tiktoken

    known = tiktoken.Encoding("classes", pat_str=r"[\p{L}\p{N}]", mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    every = (chr(c) for c in range(sys.maxunicode + 1))
    unassigned = "".join(c for c in every if unicodedata.category(c) == "Cn")
    return [c for c in regex.findall(r"[\p{L}\p{N}]", unassigned) if not known.encode_ordinary(c)]


class Coder:
    """Encodes and decodes with the ranks of a file of lines "base64 rank"; all single bytes must be tokens."""

    def __init__(self, path: str, pattern: str) -> None:
        import ahocorasick
        import regex

        with open(path, "rb") as handle:
            lines = [line.split() for line in handle if line.strip()]
        self.ranks = {base64.b64decode(token).decode("latin-1"): int(rank) for token, rank in lines}
        if any(chr(b) not in self.ranks for b in range(256)):
            raise ValueError(f"{path}: not every byte is a token")
        self.token = {rank: token for token, rank in self.ranks.items()}
        self.data = {rank: token.encode("latin-1") for rank, token in self.token.items()}
        self.find = regex.compile(pattern)
        newer = newer_characters()
        #: Such characters become one that is neither letter nor number nor space while a text is cut.
        self.as_other = {ord(c): "\xa4" for c in newer}
        self.maybe_newer = re.compile(f"[{min(newer)}-{chr(sys.maxunicode)}]").search if newer else lambda text: None
        self.words = Remembered(self._packed)
        self.pairs: dict[tuple[int, int], bool] = {}
        # Edges from the single byte up to the token; tokens that merging never makes cannot stand in an encoding of others.
        self.left_edge: dict[int, tuple[int, ...]] = {}
        self.right_edge: dict[int, tuple[int, ...]] = {}
        self.ordered = True
        automaton = ahocorasick.Automaton()
        for token, rank in sorted(self.ranks.items(), key=lambda t: t[1]):
            parts = self._halves(token)
            if parts is None:
                continue
            if len(parts) == 2:
                first, second = self.ranks[parts[0]], self.ranks[parts[1]]
                self.ordered = self.ordered and max(first, second) < rank
            known = len(parts) == 2 and first in self.left_edge and second in self.right_edge
            self.left_edge[rank] = (self.left_edge[first] if known else ()) + (rank,)
            self.right_edge[rank] = (self.right_edge[second] if known else ()) + (rank,)
            automaton.add_word(token, (len(token) - 1, rank))
        automaton.make_automaton()
        self.automaton = automaton
        self.shorter = {rank: self._prefix(self.token[rank]) for rank in self.left_edge}

    def merged(self, text: str, least: int = 1) -> list[str]:
        """Merging by rank as it is defined, the leftmost of equal ranks first; for short texts only."""
        parts = list(text)
        while len(parts) > least:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
            if rank == NEVER:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _halves(self, token: str) -> list[str] | None:
        parts = self.merged(token, 2)
        return parts if len(token) == 1 or (len(parts) == 2 and "".join(parts) in self.ranks) else None

    def _prefix(self, token: str) -> int | None:
        for end in range(len(token) - 1, 0, -1):
            rank = self.ranks.get(token[:end])
            if rank is not None and rank in self.left_edge:
                return rank
        return None

    def compatible(self, a: int, b: int) -> bool:
        answer = self.pairs.get((a, b))
        if answer is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            answer = self.pairs[a, b] = self._stays_cut(a, b)
        return answer

    def _stays_cut(self, a: int, b: int) -> bool:
        if not self.ordered:
            return self.merged(self.token[a] + self.token[b]) == [self.token[a], self.token[b]]
        left, right = self.right_edge[a] + (NEVER,), self.left_edge[b] + (NEVER,)
        i = j = 0
        while True:
            over = self.ranks.get(self.token[left[i]] + self.token[right[j]], NEVER)
            if over < left[i + 1] and over <= right[j + 1] and over != NEVER:
                return False
            if left[i + 1] == right[j + 1] == NEVER:
                return True
            if left[i + 1] <= right[j + 1]:
                i += 1
            else:
                j += 1

    def encode_word(self, word: str) -> list[int]:
        text = word.encode().decode("latin-1")
        whole = self.ranks.get(text)
        if whole is not None:
            return [whole]
        size = len(text)
        longest = [0] * size
        for end, (reach, rank) in self.automaton.iter(text):
            # Later ends are longer matches of the same start.
            longest[end - reach] = rank
        is_open = bytearray(b"\x01") * (size + 1)
        path: list[int] = []
        at, token = 0, longest[0]
        while at < size:
            while token is not None:
                end = at + len(self.token[token])
                if is_open[end] and (not path or self.compatible(path[-1], token)):
                    break
                token = self.shorter[token]
            if token is None:
                is_open[at] = 0
                token = path.pop()
                at -= len(self.token[token])
                token = self.shorter[token]
            else:
                path.append(token)
                at = end
                token = longest[at] if at < size else None
        return path

    def _packed(self, word: str) -> bytes:
        ids = self.encode_word(word)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        return b"".join(map(self.words.__getitem__, self.cut(text)))

    def cut(self, text: str) -> Iterable[str]:
        """The matches of the pattern; those of a long text one after the other."""
        if self.maybe_newer(text):
            return (text[m.start():m.end()] for m in self.find.finditer(text.translate(self.as_other)))
        return self.find.findall(text) if len(text) <= LISTED_CHARS else (m[0] for m in self.find.finditer(text))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.data.__getitem__, ids.tolist()))


class Remembered(dict):
    """Ids of words; forgets all when full, so its size is bounded."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> bytes:
        ids = self.make(word)
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = ids
        return ids


def coder(path: str, pattern: str) -> Coder:
    if (path, pattern) not in _coders:
        _coders[path, pattern] = Coder(path, pattern)
    return _coders[path, pattern]


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids): ids as little-endian 32-bit numbers. ``path`` names the ranks' file on every machine."""
    ship(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path, pattern)
        for piece in pieces(batches):
            ids = [code.encode(text or "") for text in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "n_tokens", "ids"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids binary")


def decoded(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """The rows of ``encoded`` with column ``data``: the bytes of the ids."""
    ship(rows.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path, pattern)
        for piece in pieces(batches, ("ids",)):
            data = [code.decode(np.frombuffer(b.as_buffer(), "<u4")) for b in piece.column("ids")]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(data, pa.binary())], names=[*piece.schema.names, "data"])
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary, data binary")
