"""Removal of long repeated passages by a relative Lempel-Ziv parse against an index of reference blocks.

Rule: a word goes if a window of ``WIDTH`` consecutive words that covers it also starts in a document with a smaller
doc_id. Windows are judged on the input texts.

Every document is cut where its content says so (a hash of the next ``GRAM`` words is a multiple of ``MEAN``), so equal
passages are cut alike wherever they stand. A block is all words that windows starting in one such stretch can touch. The
index of reference blocks holds the smallest doc_id of each block. A document is parsed against it: as long as its blocks
stand in the index under a smaller doc_id, one factor goes on, and all windows that start in it are copies. Where the
factor ends, the windows are looked up one by one. Only windows whose least gram is shared with another document's
unmatched stretch can have a partner, so only those are looked up. This is exact: the first document that holds a window
cannot be matched where it holds it, so a window without a factor meets its first document among the looked-up ones.

Defined cases: null and empty texts have no words; texts with fewer than ``WIDTH`` words lose none; rows without doc_id
are no reference and lose nothing; repeated rows, and other texts of the same doc_id, are no smaller document and are
treated alike; the order of the rows does not matter; further columns are carried unchanged and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.llm.shared import _maybe, kept, near_members, ship, split_join
from pulsegrid.llm.words import Words, mix, pieces, powers, signed, unsigned, windows, words_of

WIDTH, GRAM, MEAN = 50, 8, 64
#: Places of a window from which on they are dealt to several tasks.
HOT = 2048


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    done = 1
    while 2 * done <= width:
        values, done = np.minimum(values[:-done], values[done:]), 2 * done
    return np.minimum(values[:len(values) - (width - done)], values[width - done:]) if width > done else values


class Stretches:
    """The windows of some texts, cut into stretches: per window its text, start, least gram and stretch."""

    def __init__(self, words: Words) -> None:
        grams = windows(words.hashes, GRAM)
        starts = [np.arange(a, max(a, b - WIDTH + 1)) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        self.text = np.repeat(np.arange(len(starts)), [len(s) for s in starts])
        self.at = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        self.least = _least(grams, WIDTH - GRAM + 1)[self.at] if len(self.at) else np.zeros(0, np.uint64)
        cut = grams[self.at] % np.uint64(MEAN) == 0 if len(self.at) else np.zeros(0, bool)
        if len(cut):
            cut[0] = True
            cut[1:] |= self.text[1:] != self.text[:-1]
        self.begin = np.flatnonzero(cut)
        self.end = np.append(self.begin[1:], len(cut)) if len(cut) else self.begin
        self.stretch = np.cumsum(cut) - 1

    def numbers(self) -> np.ndarray:
        """The number of each stretch within its text."""
        text = self.text[self.begin]
        return np.arange(len(text)) - np.searchsorted(text, text)


def _stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        words = words_of(piece.column("text"))
        cut = Stretches(words)
        if not len(cut.begin):
            continue
        a, b = cut.at[cut.begin], cut.at[cut.end - 1] + WIDTH
        up, down = powers(len(words.hashes))
        sums = np.zeros(len(words.hashes) + 1, np.uint64)
        np.cumsum(words.hashes * up[:len(words.hashes)], out=sums[1:])
        block = mix((sums[b] - sums[a]) * down[a] + mix((b - a).astype(np.uint64)))
        new = np.ones(len(cut.at), bool)
        new[1:] = (cut.least[1:] != cut.least[:-1]) | (cut.stretch[1:] != cut.stretch[:-1])
        where = np.flatnonzero(new)
        lists = np.append(np.searchsorted(where, cut.begin), len(where)).astype(np.int32)
        text = cut.text[cut.begin]
        rows = pa.array(text)
        own = a - words.first[text]
        yield pa.RecordBatch.from_arrays([
            piece.column("doc_id").take(rows), piece.column("row_key").take(rows), pa.array(signed(block)),
            pa.array(cut.numbers().astype(np.int32)), pa.array(own.astype(np.int32)), pa.array((own + cut.end - cut.begin).astype(np.int32)),
            pa.ListArray.from_arrays(pa.array(lists), pa.array(signed(cut.least[where])))],
            names=["doc_id", "row_key", "block", "number", "begin", "end", "grams"])


def _code(gram: np.ndarray, number: np.ndarray) -> np.ndarray:
    return mix(gram + number.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _looked_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(window, doc_id, row_key, at) of windows in unmatched stretches whose least gram is shared."""
    for piece in pieces(batches):
        words = words_of(piece.column("text"))
        cut, numbers, every = Stretches(words), None, windows(words.hashes, WIDTH)
        if not len(cut.begin):
            continue
        codes = _code(cut.least, cut.numbers()[cut.stretch])
        want = np.zeros(len(codes), bool)
        first = np.searchsorted(cut.text, np.arange(piece.num_rows + 1))
        for row, asked in enumerate(piece.column("asked")):
            a, b = first[row], first[row + 1]
            numbers = np.asarray(asked.values.field("number"))
            want[a:b] = np.isin(codes[a:b], _code(unsigned(np.asarray(asked.values.field("gram"))), numbers))
        at = np.flatnonzero(want)
        rows = pa.array(cut.text[at])
        yield pa.RecordBatch.from_arrays([
            pa.array(signed(every[cut.at[at]])), piece.column("doc_id").take(rows), piece.column("row_key").take(rows),
            pa.array((cut.at[at] - words.first[cut.text[at]]).astype(np.int32))], names=["window", "doc_id", "row_key", "begin"])


def _stays(count: int, spans: pa.Scalar) -> np.ndarray:
    """Which of ``count`` words no window covers that starts in one of the spans."""
    edge = np.zeros(count + 1, np.int64)
    if spans.is_valid and len(spans):
        np.add.at(edge, np.asarray(spans.values.field("begin")), 1)
        np.add.at(edge, np.asarray(spans.values.field("end")) - 1 + WIDTH, -1)
    return np.cumsum(edge[:-1]) == 0


def _without(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words that windows starting in the given spans cover; words joined by one space."""
    for piece in pieces(batches):
        texts, removed, total = [], [], []
        for text, spans in zip(piece.column("text"), piece.column("spans"), strict=True):
            words = text.as_buffer().to_pybytes().split() if text.is_valid else []
            stay = _stays(len(words), spans)
            total.append(len(words)), removed.append(len(words) - int(stay.sum()))
            texts.append(b" ".join(compress(words, stay.tolist()) if removed[-1] else words))
        yield pa.RecordBatch.from_arrays([
            piece.column("row"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
            names=["row", "n_words", "n_removed", "kept_text"])


def _cut_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, cut_text): the bytes of removed words go with the white space behind them, or before them at the text's end."""
    for piece in pieces(batches):
        texts = []
        for text, spans in zip(piece.column("text"), piece.column("spans"), strict=True):
            words = words_of(pa.array([text.as_py()], pa.string()))
            gone = np.concatenate(([False], ~_stays(len(words.starts), spans), [False]))
            first, end = np.flatnonzero(gone[1:] & ~gone[:-1]), np.flatnonzero(gone[:-1] & ~gone[1:])
            starts, ends = np.append(words.starts, -1), np.concatenate(([0], words.ends))
            data, parts, at = words.data.tobytes(), [], 0
            for a, b in zip(first.tolist(), end.tolist(), strict=True):
                last = b == len(words.starts)
                parts.append(data[at:ends[a] if last else starts[a]])
                at = ends[b] if last else starts[b]
            texts.append(b"".join([*parts, data[at:]]) if text.is_valid else None)
        yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(texts, pa.binary()).cast(pa.string())], names=["row", "cut_text"])


def _row_key() -> Column:
    return F.xxhash64("text").alias("row_key")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, begin, end): windows that start at words begin … end - 1 repeat a smaller document."""
    texts = docs.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), _row_key(), "text")
    cut = kept(texts.mapInArrow(
        _stretches, "doc_id long, row_key long, block long, number int, begin int, end int, grams array<long>"), "repeats-blocks")
    index = cut.groupBy("block").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most").select("block", "least")
    parsed = kept(cut.join(index, "block", "left").select(
        "doc_id", "row_key", "number", "begin", "end", "grams", F.expr("coalesce(doc_id > least, false)").alias("factor")), "repeats-parsed")

    open_grams = parsed.filter("not factor").select("doc_id", "row_key", "number", F.explode("grams").alias("gram"))
    shared = open_grams.groupBy("gram").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most").select("gram")
    asked = kept(open_grams.join(shared, "gram").groupBy("doc_id", "row_key").agg(
        F.collect_set(F.struct("number", "gram")).alias("asked")), "repeats-asked")
    near = near_members(texts, "doc_id", asked.select("doc_id")).join(asked, ["doc_id", "row_key"])
    found = kept(near.select("doc_id", "row_key", "text", "asked").mapInArrow(
        _looked_up, "window long, doc_id long, row_key long, begin int").distinct(), "repeats-windows")
    first = kept(found.groupBy("window").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("places")).filter("least < most"), "repeats-first")
    hot = first.filter(F.col("places") > HOT).select("window")
    joined = split_join(found, first.select("window", "least"), "window", hot, F.struct("doc_id", "begin"))
    single = joined.filter("doc_id > least").select("doc_id", "row_key", "begin", (F.col("begin") + 1).alias("end"))
    return parsed.filter("factor").select("doc_id", "row_key", "begin", "end").unionByName(single).distinct()


def _with_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row, text, spans) of rows that may have spans, and (row, text) of those that surely have none."""
    ship(docs.sparkSession)
    spans = kept(repeated_spans(docs).groupBy("doc_id", "row_key").agg(
        F.collect_list(F.struct("begin", "end")).alias("spans")), "repeats-spans")
    # Texts without spans, most of them, are not shuffled.
    marked = _maybe(docs, "doc_id", spans.select("doc_id"), 1 << 22).select(
        "row", F.col("key").cast("long").alias("doc_id"), F.xxhash64("row.text").alias("row_key"), "maybe")
    hit = marked.filter("maybe").join(spans, ["doc_id", "row_key"], "left").select("row", F.col("row.text").alias("text"), "spans")
    return hit, marked.filter(~F.col("maybe")).select("row", F.col("row.text").alias("text"))


def _row_type(docs: DataFrame) -> T.StructField:
    return T.StructField("row", docs.schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """(row, n_words, n_removed, kept_text): every input row as a struct, with its words that stay, joined by one space."""
    hit, rest = _with_spans(docs)
    both = rest.withColumn("spans", F.lit(None).cast(hit.schema["spans"].dataType)).unionByName(hit)
    return both.mapInArrow(_without, T.StructType([
        _row_type(docs), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]))


def shortened(docs: DataFrame) -> DataFrame:
    """The documents with repeated passages cut out of their texts and n_chars following; the columns stay.

    A text that loses nothing stays as it is, and what stays of another one keeps its white space.
    """
    hit, rest = _with_spans(docs)
    hit = hit.filter("spans is not null").mapInArrow(_cut_out, T.StructType([_row_type(docs), T.StructField("cut_text", T.StringType())])).unionByName(
        hit.filter("spans is null").select("row", F.col("text").alias("cut_text")))
    rows = hit.unionByName(rest.select("row", F.col("text").alias("cut_text")))
    changed = {"text": F.col("cut_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("row.text") == F.col("cut_text"), F.col("row.n_chars")).otherwise(F.length("cut_text")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[changed[c].alias(c) if c in changed else F.col("row").getField(c).alias(c) for c in docs.columns])
