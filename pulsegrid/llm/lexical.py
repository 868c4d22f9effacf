"""Ranked lexical search, reversed: an index of the items' terms is broadcast and the documents stream through it.

Items come in blocks of at most ``BLOCK_BYTES`` of distinct text. For each block all documents are read once: every task
counts, per document, the terms that the block's vocabulary holds, and the counts are landed. Totals and document
frequencies are sums over them. Then the counts stream through the inverted index (term to items): each document's scores
are added up in integers, and those that beat the weakest entry of an item's heap enter it. A heap holds ``k`` documents.
The heaps of all tasks are merged in two steps.

Defined cases: null and empty texts, and texts without terms, are no documents that count and rank nowhere; items without
terms get no rows; items of equal text get equal rows under each item_id; repeated documents rank one by one, as equal
scores do by ascending doc_id, those without doc_id last; an empty table gives no rows; other columns are not read,
whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.blocks import in_blocks, merged_best
from pulsegrid.llm.shared import kept, ship
from pulsegrid.llm.words import _texts, pieces

K = 10
#: Text of a block of items, and scores and index entries that a task handles at once.
BLOCK_BYTES, CELLS = 8 << 20, 1 << 21

_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def terms_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of some texts one after the other, and where those of each text begin. Bytes of one character stay together."""
    data, offsets = _texts(column)
    inside = _TERM[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    starts = np.flatnonzero(inside & (fresh[:-1] | ~np.concatenate(([False], inside[:-1]))[:len(inside)]))
    ends = np.flatnonzero(inside & (fresh[1:] | ~np.concatenate((inside[1:], [False]))[:len(inside)])) + 1
    bounds = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(_LOWER[data[inside]]))
    return terms, np.searchsorted(starts, offsets)


class Index:
    """The items' terms, and for each term the items that hold it and how often."""

    def __init__(self, texts: list[str]) -> None:
        terms, first = terms_of(pa.array(texts, pa.string()))
        coded = terms.dictionary_encode()
        self.terms = coded.dictionary
        item = np.repeat(np.arange(len(texts)), np.diff(first))
        pairs, self.times = np.unique(coded.indices.to_numpy().astype(np.int64) * max(len(texts), 1) + item, return_counts=True)
        term, self.item = pairs // max(len(texts), 1), pairs % max(len(texts), 1)
        self.begin = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.items = len(texts)


def _counted(shared) -> Callable:
    """(doc_id, n, terms, times) of every document: its length in terms, and its counts of the index's terms."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.terms
        for piece in pieces(batches):
            terms, first = terms_of(piece.column("text"))
            number = pc.fill_null(pc.index_in(terms, value_set=known), -1).to_numpy().astype(np.int64)
            row = np.repeat(np.arange(piece.num_rows), np.diff(first))
            hit = number >= 0
            pairs, times = np.unique(row[hit] * len(known) + number[hit], return_counts=True)
            lists = pa.array(np.searchsorted(pairs, np.arange(piece.num_rows + 1) * len(known)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id"), pa.array(np.diff(first).astype(np.int64)),
                pa.ListArray.from_arrays(lists, pa.array((pairs % max(len(known), 1)).astype(np.int32))),
                pa.ListArray.from_arrays(lists, pa.array(times.astype(np.int32)))], names=["doc_id", "n", "terms", "times"])
    return run


class Heaps:
    """The ``k`` best documents of each item: a heap's first entry is the weakest, with the larger doc_id among equals."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.heaps, self.bar = k, [[] for _ in range(items)], np.ones(items, np.int64)

    def offer(self, scores: np.ndarray, doc_ids: list[int | None]) -> None:
        """Scores of documents (rows) for all items (columns)."""
        for row, item in zip(*(x.tolist() for x in np.nonzero(scores >= self.bar)), strict=True):
            heap, own = self.heaps[item], doc_ids[row]
            entry = (int(scores[row, item]), -math.inf if own is None else -own)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.bar[item] = heap[0][0]


def _ranked(shared, weights: np.ndarray, total: int, length: int, k: int) -> Callable:
    """(query, doc_id, score, task): the heaps of a task."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, heaps = shared.value, None
        most = max(1, CELLS // index.items)
        step = min(32, most)
        for batch in batches:
            heaps = heaps or Heaps(index.items, k)
            n = batch.column("n").to_numpy()
            m = 100 - 75 + (75 * n * total) // max(length, 1)
            column = batch.column("terms")
            ends = column.offsets.to_numpy().astype(np.int64)
            term, tf = column.values.to_numpy().astype(np.int64), batch.column("times").values.to_numpy().astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            term, tf = term[ends[0]:ends[-1]], tf[ends[0]:ends[-1]]
            gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
            ids, at = batch.column("doc_id").to_pylist(), 0
            while at < batch.num_rows:
                to = min(at + step, batch.num_rows)
                scores = np.zeros((to - at, index.items), np.int64)
                _add(scores, index, *(x[ends[at] - ends[0]:ends[to] - ends[0]] for x in (row - at, term, gain)))
                heaps.offer(scores, ids[at:to])
                # The first documents fill the heaps; more of them are taken at once when few can still enter.
                at, step = to, min(2 * step, most)
        if heaps:
            found = [(q, None if i == -math.inf else -i, s) for q, heap in enumerate(heaps.heaps) for s, i in heap]
            query, doc_id, score = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([
                pa.array(query, pa.int32()), pa.array(doc_id, pa.int64()), pa.array(score, pa.int64()),
                pa.array([TaskContext.get().partitionId()] * len(found), pa.int32())], names=["query", "doc_id", "score", "task"])
    return run


def _add(scores: np.ndarray, index: Index, row: np.ndarray, term: np.ndarray, gain: np.ndarray) -> None:
    """Adds each document's gains to the items that hold the term, so many index entries at a time."""
    flat, count = scores.reshape(-1), index.begin[term + 1] - index.begin[term]
    ahead, at = np.concatenate(([0], np.cumsum(count))), 0
    while at < len(term):
        to = max(at + 1, int(np.searchsorted(ahead, ahead[at] + CELLS, "right")) - 1)
        which = np.repeat(np.arange(at, to), count[at:to])
        entry = index.begin[term[which]] + np.arange(ahead[at], ahead[to]) - ahead[which]
        np.add.at(flat, row[which] * index.items + index.item[entry], gain[which] * index.times[entry])
        at = to


def weights_of(total: int, frequency: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(df) + 1))) for df in frequency], np.int64)


def ranked(docs: DataFrame, items: DataFrame, k: int = K, limit: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item (item_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    asked = asked.withColumn("digest", F.md5(F.col("text").cast("binary")))
    queries, blocks = in_blocks(asked.groupBy("digest").agg(F.first("text").alias("text")), F.col("digest"), F.octet_length("text") + 64, limit)
    found = []
    for block in range(blocks):
        # A block's text is bounded, so its rows fit the driver and its index may be broadcast.
        own = queries.filter(F.col("block") == block).select("digest", "text").orderBy("digest").collect()
        if own:
            found.append(_best_of_block(texts, [r.text for r in own], k).join(
                F.broadcast(spark.createDataFrame([(i, r.digest) for i, r in enumerate(own)], "query int, digest string")), "query"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return asked.select("item_id", "digest").join(reduce(DataFrame.unionByName, found), "digest").select("item_id", "rank", "doc_id", "score")


def _best_of_block(texts: DataFrame, asked: list[str], k: int) -> DataFrame:
    spark, index = texts.sparkSession, Index(asked)
    shared = spark.sparkContext.broadcast(index)
    counts = kept(texts.mapInArrow(_counted(shared), "doc_id long, n long, terms array<int>, times array<int>"), "search-counts")
    total, length = counts.agg(F.count(F.when(F.col("n") > 0, True)), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = np.zeros(len(index.terms), np.int64)
    for term, df in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequency[term] = df
    best = counts.mapInArrow(_ranked(shared, weights_of(total, frequency), total, length, k), "query int, doc_id long, score long, task int")
    return merged_best(best, ["query"], [F.desc("score"), F.asc_nulls_last("doc_id")], k)


def sql(k: int = K) -> str:
    """The same in DuckDB SQL over views documents and benchmark."""
    term = r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
    return rf"""
with words as (select doc_id, {term} as term from documents),
sizes as (select doc_id, count(*) as n from words group by doc_id),
total as (select count(*) as docs, sum(n)::bigint as length from sizes),
frequency as (select term, count(distinct doc_id) as df from words group by term),
weights as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)))::bigint as w from frequency, total),
asked as (select item_id, term, count(*) as times from (select item_id, {term} as term from benchmark) group by all),
counts as (select doc_id, term, count(*) as tf from words semi join asked using (term) group by all),
gains as (select doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // length)))) as gain
  from counts join sizes using (doc_id) join weights using (term), total),
scores as (select item_id, doc_id, sum(times * gain)::bigint as score from asked join gains using (term) group by all)
select item_id, rank::int as rank, doc_id, score from (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0) where rank <= {k}"""
