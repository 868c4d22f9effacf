"""Hard negatives by exact integer scores, computed as matrix products in a residue number system.

Components become integers. Their inner products are computed modulo several small primes as float32 matrix products of
residues around zero: a product over so many dimensions that no sum leaves 2**24 is exact in float32, whatever the order of
the additions. Mixed-radix Chinese remaindering puts the residues together in 64-bit integers. The primes are the fewest
whose product exceeds twice the largest possible score, by Cauchy-Schwarz over the norms of all rows.

Anchors are the stated query set. They come in blocks of at most ``BLOCK_BYTES``; a block is collected and broadcast, and all
rows stream past it twice: once against the anchors of their own label, for the positives, and once against those of other
labels, for the rows in each positive's window of scores. Tasks keep the best few of each anchor or window; those are merged
in two steps. Rows are never joined with each other.

Defined cases: rows without vec_id, with null label or vector, or with a null or non-finite component take no part; ties go
to the smaller vec_id; rows of the anchor's vec_id are not its positives; repeated rows are candidates one by one, equal anchor
rows are one anchor; vectors of different length have no score, empty ones score 0; an anchor without positives, and a window
without rows, give no rows; an empty table gives none; other columns are not read. Components so large that a score could
leave 2**56 raise an error before anything is mined.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.blocks import Best, in_blocks, merged_best
from pulsegrid.llm.shared import kept, ship

SCALE, ANCHOR_EVERY, SHIFT_EVERY, LABELS = 256, 100, 7, 10
POSITIVES, NEGATIVES = 5, 5
#: Lowest score of a negative, in hundredths of the positive's.
WINDOW = 80
#: Integers of a block of anchors, scores that a task holds at once, largest score.
BLOCK_BYTES, CELLS, LARGEST = 32 << 20, 1 << 20, 1 << 56
#: Primes are below this, so that 64 products of residues around zero stay below 2**24.
PRIMES_BELOW = 1022


def moduli(bound: int) -> list[int]:
    """The fewest primes, from the largest on, whose product exceeds twice the bound."""
    primes, product, p = [], 1, PRIMES_BELOW
    while product <= 2 * bound:
        p -= 1
        if all(p % q for q in range(2, math.isqrt(p) + 1)):
            primes.append(p)
            product *= p
    return primes


def residues(x: np.ndarray, p: int) -> np.ndarray:
    r = x % p
    return (r - p * (r > p // 2)).astype(np.float32)


def exact_scores(x: np.ndarray, anchors: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Inner products of the integer rows of ``x`` with anchors given as residues for each prime."""
    product = 1
    total = np.zeros((len(x), len(anchors[0])), np.int64)
    for p, own in zip(primes, anchors, strict=True):
        mine, width = residues(x, p), (1 << 24) // (p // 2) ** 2
        value = np.zeros(total.shape, np.int64)
        for a in range(0, x.shape[1], width):
            value += (mine[:, a:a + width] @ own[:, a:a + width].T).astype(np.int64)
        # The next digit: what is missing modulo this prime, divided by the product of those before.
        digit = (value - total) % p * pow(product, -1, p) % p
        total += digit * product
        product *= p
    return total - product * (total > product // 2)


def _integers(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, integer vectors) of the rows that take part, by length of the vectors."""
    column = batch.column("embedding")
    column = column.cast(pa.list_(pa.float64()))
    ends, values = column.offsets.to_numpy().astype(np.int64), column.values
    x = values.to_numpy(zero_copy_only=False).astype(np.float64)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(x) | pc.is_null(values).to_numpy(zero_copy_only=False))))
    able = (bad[ends[1:]] == bad[ends[:-1]])
    for name in ("vec_id", "label", "embedding"):
        able &= batch.column(name).is_valid().to_numpy(zero_copy_only=False)
    ids, labels = (pc.fill_null(batch.column(c), 0).to_numpy() for c in ("vec_id", "label"))
    labels = np.where(ids % SHIFT_EVERY == 0, (labels + 1) % LABELS, labels)
    size = np.diff(ends)
    for length in np.unique(size[able]):
        at = np.flatnonzero(able & (size == length))
        yield ids[at], labels[at], np.floor(SCALE * x[ends[at][:, None] + np.arange(length)])


def _anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, dims, raw, norm): anchors as 64-bit integers; rows without vec_id hold the largest norm of a batch."""
    for batch in batches:
        for ids, labels, x in _integers(batch):
            norm = (x * x).sum(axis=1)
            own = np.flatnonzero(ids % ANCHOR_EVERY == 0)
            # Larger values are refused before they are used, so the conversion cannot overflow.
            raws = [x[i].astype(np.int64).tobytes() if norm[i] < LARGEST else b"" for i in own]
            nothing = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([pa.array(ids[own], pa.int64()), nothing]), pa.concat_arrays([pa.array(labels[own], pa.int64()), nothing]),
                pa.array([x.shape[1]] * (len(own) + 1), pa.int32()), pa.array([*raws, None], pa.binary()),
                pa.array(np.append(norm[own], norm.max()))], names=["vec_id", "label", "dims", "raw", "norm"])


class Anchors:
    """A block of anchors: ids, labels, and residues for each prime, by length of the vectors."""

    def __init__(self, rows: list, primes: list[int]) -> None:
        self.primes, self.count = primes, len(rows)
        self.ids, self.labels = np.array([r.vec_id for r in rows], np.int64), np.array([r.label for r in rows], np.int64)
        self.dims = np.array([r.dims for r in rows], np.int64)
        self.residues = {}
        for length in np.unique(self.dims):
            at = np.flatnonzero(self.dims == length)
            x = np.frombuffer(b"".join(rows[i].raw for i in at), np.int64).reshape(len(at), length)
            self.residues[int(length)] = at, [residues(x, p) for p in primes]

    def scored(self, batch: pa.RecordBatch, same_label: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(anchors, ids, scores): all rows of the batch against the anchors of the same or of other labels."""
        for ids, labels, x in _integers(batch):
            at, own = self.residues.get(x.shape[1], (np.zeros(0, np.int64), []))
            for label in np.unique(labels) if len(at) else ():
                mine = np.flatnonzero((self.labels[at] == label) == same_label)
                rows = np.flatnonzero(labels == label)
                parts, step = [r[mine] for r in own], max(1, CELLS // max(len(mine), 1))
                for a in range(0, len(rows) if len(mine) else 0, step):
                    some = rows[a:a + step]
                    yield at[mine], ids[some], exact_scores(x[some].astype(np.int64), parts, self.primes)


def _output(best: Best) -> pa.RecordBatch:
    best.settle()
    return pa.RecordBatch.from_arrays([
        pa.array(best.group, pa.int64()), pa.array(best.id, pa.int64()), pa.array(best.score, pa.int64()),
        pa.array(np.full(len(best.group), TaskContext.get().partitionId(), np.int32))], names=["place", "vec_id", "score", "task"])


FOUND = "place long, vec_id long, score long, task int"


def _positives(shared) -> Callable:
    """The best rows of the own label; the place is the anchor's."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        best = Best(anchors.count, POSITIVES)
        for batch in batches:
            for at, ids, scores in anchors.scored(batch, True):
                row, column = np.nonzero((scores >= best.bar[at]) & (ids[:, None] != anchors.ids[at]))
                best.add(at[column], scores[row, column], ids[row])
        yield _output(best)
    return run


def _negatives(shared) -> Callable:
    """The best rows of other labels in each window; the place is POSITIVES * anchor + number of the positive."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, low, high = shared.value
        best = Best(low.size, NEGATIVES)
        for batch in batches:
            for at, ids, scores in anchors.scored(batch, False):
                least = np.maximum(low, best.bar.reshape(low.shape))[at]
                row, column = np.nonzero((scores >= least.min(axis=1)) & (scores <= high[at].max(axis=1)))
                score, own = scores[row, column], at[column]
                for j in range(POSITIVES):
                    hit = (score >= least[column, j]) & (score <= high[own, j])
                    best.add(own[hit] * POSITIVES + j, score[hit], ids[row[hit]])
        yield _output(best)
    return run


def mined(vectors: DataFrame, limit: int = BLOCK_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of vectors (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    described = kept(rows.mapInArrow(_anchors, "vec_id long, label long, dims int, raw binary, norm double"), "negatives-anchors")
    largest = described.agg(F.max("norm")).first()[0]
    if largest is None:
        return _result(spark.createDataFrame([], "anchor_id long, positive_id long, rank int, vec_id long, positive_score long, score long"))
    if largest * 1.001 >= LARGEST:
        raise ValueError(f"scores may reach {largest:.3g}; at most {LARGEST} is exact")
    primes = moduli(math.ceil(largest * 1.001) + 1)
    distinct = described.filter("vec_id is not null").select("vec_id", "label", "dims", "raw").distinct()
    anchors, blocks = in_blocks(distinct, F.struct("vec_id", "raw"), F.octet_length("raw") + 64, limit)
    found = []
    for block in range(blocks):
        # A block's vectors are bounded, so they fit the driver and may be broadcast; so may five scores for each.
        own = Anchors(anchors.filter(F.col("block") == block).orderBy("vec_id", "label", "raw").collect(), primes)
        if own.count:
            found.append(_negatives_of(rows, own))
    return _result(reduce(DataFrame.unionByName, found)) if found else _result(
        spark.createDataFrame([], "anchor_id long, positive_id long, rank int, vec_id long, positive_score long, score long"))


def _negatives_of(rows: DataFrame, anchors: Anchors) -> DataFrame:
    spark, order = rows.sparkSession, [F.desc("score"), F.asc("vec_id")]
    near = rows.mapInArrow(_positives(spark.sparkContext.broadcast(anchors)), FOUND)
    chosen = merged_best(near, ["place"], order, POSITIVES).collect()
    low, high = np.ones((anchors.count, POSITIVES), np.int64), np.zeros((anchors.count, POSITIVES), np.int64)
    named = []
    for r in chosen:
        low[r.place, r.rank - 1], high[r.place, r.rank - 1] = -(-WINDOW * r.score // 100), r.score
        named.append((r.place * POSITIVES + r.rank - 1, int(anchors.ids[r.place]), r.vec_id, r.score))
    windows = F.broadcast(spark.createDataFrame(named, "place long, anchor_id long, positive_id long, positive_score long"))
    found = rows.mapInArrow(_negatives(spark.sparkContext.broadcast((anchors, low, high))), FOUND)
    return merged_best(found, ["place"], order, NEGATIVES).join(windows, "place").select(
        "anchor_id", "positive_id", "rank", "vec_id", "positive_score", "score")


def _result(found: DataFrame) -> DataFrame:
    return found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def sql() -> str:
    """The same in DuckDB SQL over view embeddings."""
    return f"""
with rows as (select vec_id, case when vec_id % {SHIFT_EVERY} = 0 then (label + 1) % {LABELS} else label end as label,
    list_transform(embedding, lambda x: floor({SCALE} * x::double)) as v
  from embeddings where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same, list_dot_product(a.v, r.v)::bigint as score
  from rows a, rows r where a.vec_id % {ANCHOR_EVERY} = 0 and a.vec_id <> r.vec_id and len(a.v) = len(r.v)),
positives as (select anchor_id, vec_id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {POSITIVES})
select anchor_id, positive_id, rank::int as rank, vec_id as negative_id, positive_score, score as negative_score from (
  select p.*, s.vec_id, s.score, row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id) as rank
  from positives p join scores s on s.anchor_id = p.anchor_id and not s.same
    and {WINDOW} * positive_score <= 100 * s.score and s.score <= positive_score) where rank <= {NEGATIVES}"""
