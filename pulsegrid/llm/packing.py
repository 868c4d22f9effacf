"""Packing by concatenating and cutting.

Pass one tokenizes every document where it is read, appends the end id, and lands the ids with the number of tokens before
them in their partition. The totals of the partitions, one row each, are summed in order; that gives every document its
place in the one long line of tokens. Pass two cuts the line into windows of ``LENGTH``: a document gets one record for
each window it touches. Nothing is shuffled but the totals, and only the last sequence is padded.

Defined cases: a null or empty text is its end id alone; rows without doc_id and repeated rows are packed like others;
texts longer than a window lie in several; no rows give no sequences; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.shared import kept, ship
from pulsegrid.llm.words import _SPACE, _texts, pieces

LENGTH, END_ID = 4096, 2
#: Text bytes whose distinct words are found at once; a longer text is handled alone.
PIECE_BYTES = 4 << 20
#: Words of other than common letters whose ids a Python worker remembers.
REMEMBERED = 300_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

_known: dict[str, tuple[object, LetterWords, dict[bytes, bytes]]] = {}


def _tokenizer(path: str) -> tuple[object, LetterWords, dict[bytes, bytes]]:
    """The tokenizer, its fast form, and the ids of other words seen so far in this worker, as 32-bit little-endian bytes."""
    if path not in _known:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _known[path] = tokenizer, LetterWords(path, tokenizer), {}
    tokenizer, letters, ids = _known[path]
    if len(ids) > REMEMBERED:
        ids.clear()
    return tokenizer, letters, ids


def _bare(word: bytes) -> bytes:
    """The word without a comma or stop behind its letters; other words as they are.

    This tokenizer splits letters from what is no letter, so the mark's ids can be put behind the letters' ids. It writes
    U+0130 in lower case as i and a combining dot, which is no letter and goes with the mark, so such words stay whole.
    """
    letters = word[:-1].decode() if word[-1:] in (b",", b".") else ""
    return word[:-1] if letters.isalpha() and max(letters) < "\u0250" and "\u0130" not in letters else word


def _learn(tokenizer, ids: dict[bytes, bytes], words: list[bytes]) -> None:
    bare = {w: _bare(w) for w in words}
    _encode_into(tokenizer, ids, sorted({b for b in [*bare.values(), b",", b"."] if b not in ids}))
    for word, letters in bare.items():
        if word is not letters:
            ids[word] = ids[letters] + ids[word[-1:]]


def _encode_into(tokenizer, ids: dict[bytes, bytes], words: list[bytes]) -> None:
    texts = [w.decode() for w in words]
    plain = [t for t in texts if "<|" not in t]
    found = tokenizer.encode(plain, is_pretokenized=True, add_special_tokens=False) if plain else None
    if found:
        numbers, owner = np.array(found.ids, "<u4"), np.array(found.word_ids, np.int64)
        cut = np.searchsorted(owner, np.arange(len(plain) + 1))
        for i, text in enumerate(plain):
            ids[text.encode()] = numbers[cut[i]:cut[i + 1]].tobytes()
    for text in texts:
        if "<|" in text:
            ids[text.encode()] = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _spelled(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts one after the other, and where those of each text begin.

    Words are in lower case but in texts that hold the start of a control string.
    """
    data, offsets = _texts(column)
    inside = np.append(~_SPACE[data], False)
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    starts = np.flatnonzero(inside & (fresh | ~np.concatenate(([False], inside[:-1]))))
    ends = np.flatnonzero(inside[:-1] & (fresh[1:] | ~inside[1:])) + 1
    spelled = _LOWER[data]
    for row in np.unique(np.searchsorted(offsets, np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|"))), "right")) - 1:
        spelled[offsets[row]:offsets[row + 1]] = data[offsets[row]:offsets[row + 1]]
    bounds = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(spelled[inside[:-1]])])
    return words, np.searchsorted(starts, offsets)


class LetterWords:
    """Fast encoding of words of the letters a-z and U+00C0-U+00FF, many at a time.

    The tokenizer merges pairs by rank from single bytes on, the last one marked as the word's end. Here the end is a zero
    byte whose merge with the byte before it ranks before all others, so the same merges follow. It is used only for a
    tokenizer whose ids follow the order of its merges.
    """

    def __init__(self, path: str, tokenizer) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as handle:
            model = json.load(handle)["model"]
        end, vocabulary = model["end_of_word_suffix"], model["vocab"]
        byte_of = bytes_of_characters()
        ranks = {}
        for token, number in vocabulary.items():
            bare = token.removesuffix(end)
            if all(c in byte_of for c in bare):
                ranks[bytes(byte_of[c] for c in bare) + (b"\0" if bare != token else b"")] = number
        order = [vocabulary["".join(pair)] for pair in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])]
        single = [vocabulary[c] for c in byte_of] + [vocabulary[c + end] for c in byte_of]
        if order != sorted(order) or max(single) > order[0]:
            raise ValueError(f"{path}: ids do not follow the order of the merges")
        self.encoding = tiktoken.Encoding("letters", pat_str=r"[^\x00]*\x00", mergeable_ranks=ranks, special_tokens={})
        self.is_end = np.zeros(max(ranks.values()) + 1, bool)
        self.is_end[[n for t, n in ranks.items() if t.endswith(b"\0")]] = True
        self.mark_id = np.zeros(256, np.uint32)
        for mark in ",.":
            (self.mark_id[ord(mark)],) = tokenizer.encode(mark, add_special_tokens=False).ids

    def encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(simple, ids, sizes): which words are of such letters, with or without a comma or stop behind, and their ids."""
        bounds = np.frombuffer(words.buffers()[1], np.int64)[:len(words) + 1]
        data = np.frombuffer(words.buffers()[2], np.uint8)[:bounds[-1]].copy()
        # The letters U+00C0 to U+00FF are the byte C3 and a second one, but for the signs of multiplication and division.
        second = np.concatenate(([False], data[:-1] == 0xC3)) if len(data) else np.zeros(0, bool)
        letter = ((data >= ord("a")) & (data <= ord("z"))) | (data == 0xC3) | (second & (data != 0x97) & (data != 0xB7))
        odd = np.concatenate(([0], np.cumsum(~letter)))
        odd, last = odd[bounds[1:]] - odd[bounds[:-1]], bounds[1:] - 1
        marked = (odd == 1) & np.isin(data[last], np.frombuffer(b",.", np.uint8)) & (np.diff(bounds) > 1)
        simple = (odd == 0) | marked
        mark = self.mark_id[data[last[marked]]]
        data[second & (data >= 0x80) & (data < 0x9F)] += 0x20
        data[last[marked]] = 0
        chosen = np.repeat(simple, np.diff(bounds))
        ends = np.cumsum(np.diff(bounds) * simple)[simple & ~marked]
        text = np.insert(data[chosen], ends, 0).tobytes().decode()
        ids = np.array(self.encoding.encode_ordinary(text), np.uint32)
        stops = np.flatnonzero(self.is_end[ids]) + 1
        has_mark = marked[simple]
        ids = np.insert(ids, stops[has_mark], mark)
        return simple, ids, np.diff(stops, prepend=0) + has_mark


def bytes_of_characters() -> dict[str, int]:
    """Byte-level files write a byte as a printable character: itself, or the next free one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def _tokenized(path: str) -> callable:
    """White space separates words for this tokenizer and upper case is lost, so each distinct lower-cased word of a piece is
    encoded once, and the texts gather its ids.

    Words of common letters are encoded together, others through the tokenizer and remembered. Words that hold the start of a
    control string keep their case and go through the tokenizer alone.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for piece in pieces(batches, limit=PIECE_BYTES):
            tokenizer, letters, ids = _tokenizer(path)
            words, first = _spelled(piece.column("text"))
            coded = words.dictionary_encode()
            simple, flat, sizes = letters.encoded(coded.dictionary)
            others = coded.dictionary.filter(pa.array(~simple)).to_pylist()
            new = [w for w in others if w not in ids]
            if new:
                _learn(tokenizer, ids, sorted(new))
            known = [ids[w] for w in others]
            # Ids of the simple words, of the others, and the end id, which stands behind the words of each text.
            flat = np.concatenate((flat, np.frombuffer(b"".join(known), "<u4"), [END_ID]))
            if flat.max() >= 1 << 16:
                raise ValueError(f"{path}: ids of 65,536 and above do not fit into the landed table")
            size = np.concatenate((sizes, np.fromiter(map(len, known), np.int64, len(known)) // 4, [1]))
            number = np.empty(len(simple) + 1, np.int64)
            number[np.concatenate((np.flatnonzero(simple), np.flatnonzero(~simple), [len(simple)]))] = np.arange(len(number))
            word = number[np.insert(coded.indices.to_numpy(), first[1:], len(simple))]
            count = size[word]
            place = np.concatenate(([0], np.cumsum(count)))
            tokens = flat.astype("<u2")[np.repeat((np.cumsum(size) - size)[word] - place[:-1], count) + np.arange(place[-1])]
            bounds = place[first + np.arange(len(first))]
            lengths = np.diff(bounds)
            starts = before + bounds[:-1]
            before += int(lengths.sum())
            column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(2 * bounds), pa.py_buffer(tokens)])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(lengths), part, np.int32)), pa.array(starts), piece.column("doc_id"), pa.array(lengths), column.cast(pa.binary())],
                names=["part", "before", "doc_id", "doc_tokens", "ids"])
    return run


def _cut(length: int) -> callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, ("ids",)):
            at = piece.column("at").to_numpy()
            tokens = piece.column("doc_tokens").to_numpy()
            first, last = at // length, (at + tokens - 1) // length
            count = last - first + 1
            row = np.repeat(np.arange(len(at)), count)
            window = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            begin = np.maximum(window * length, at[row])
            size = np.minimum((window + 1) * length, at[row] + tokens[row]) - begin
            start = begin - at[row]
            whole = [np.frombuffer(b.as_buffer(), "<u2").astype("<u4").tobytes() for b in piece.column("ids")]
            cuts = [whole[r][4 * s:4 * (s + n)] for r, s, n in zip(row.tolist(), start.tolist(), size.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(size), pa.array(cuts, pa.binary()), pa.array(tokens[row]),
                pa.array(window), pa.array(begin - window * length)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
    return run


def packed_pieces(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset); ids are 32-bit little-endian.

    ``path`` names the tokenizer's file on every machine; its ids must be below 65,536.
    """
    ship(docs.sparkSession)
    line = kept(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _tokenized(path), "part int, before long, doc_id long, doc_tokens long, ids binary"), "packing-ids")
    totals = line.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    # One row of two numbers for each partition of pass one.
    offsets = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("ahead"))
    placed = line.join(F.broadcast(offsets), "part").select(
        "doc_id", "doc_tokens", "ids", (F.col("before") + F.col("ahead")).alias("at"))
    return placed.mapInArrow(
        _cut(length), "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def padded_length(tokens: Column, length: int = LENGTH) -> Column:
    """Sequences are padded to ``length``; one whose size is a power of two stays as it is."""
    return F.when(F.bit_count(tokens) == 1, tokens).otherwise(F.lit(length))


def sequences(parts: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, ids array): pieces put together and padded. A sequence has at most ``length`` tokens."""
    ship(parts.sparkSession)
    together = parts.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    sized = together.withColumn("padded", padded_length(F.col("n_tokens"), length).cast("long"))

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for p, size in zip(batch.column("p").to_pylist(), batch.column("padded").to_pylist(), strict=True):
                own = np.frombuffer(b"".join(x["ids"] for x in p), "<u4")
                rows.append(np.concatenate((own, np.full(size - len(own), pad_id, "<u4"))).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("sequence_id"), batch.column("n_tokens"), pa.array(rows, pa.list_(pa.int32()))],
                                             names=["sequence_id", "n_tokens", "ids"])
    return sized.select("sequence_id", "n_tokens", "padded", "p").mapInArrow(fill, "sequence_id long, n_tokens long, ids array<int>")


def digests(parts: DataFrame) -> DataFrame:
    return parts.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
