"""Near-duplicate vectors by collision counting on one-dimensional projections.

Vectors of one label link when their cosine, in double precision, is at least ``COSINE``. Equal vectors of a label are one
point. A projection of a unit vector on a Gaussian direction moves by a normal value of deviation at most
``SIGMA = sqrt(2 - 2 * COSINE)`` between linked vectors. Points are dealt to cells by ``g`` projections rounded to
``CELL``, in several tables; in a cell every point looks, in ``COUNTED`` sorted projections, at the window of
``WINDOW * SIGMA`` around its own value, and the windows that hold another point are counted. Pairs that reach ``NEEDED``
are verified by their cosine.

The cells see sketches only: the counted projections as 16-bit numbers. A first pass keeps, of each cell, the points whose
windows reach the count with some other point; vectors are joined to those alone, and a second pass counts among them and
verifies. So a vector without a near one is shuffled with no cell, and a point leaves a cell at most once, never its pairs.

Calibration: ``NEEDED`` is the largest count that a pair at the limit reaches with probability 0.999; ``g`` grows with the
logarithm of the largest label, and the number of tables is the least for which a pair at the limit meets in one with
probability ``RECALL``. More similar pairs are found with higher probability. A pair is counted in the first table where
it meets, so nothing has to be made distinct; tasks return sums of links and spanning edges, never all pairs. Cells
above ``BLOCK`` points are dealt to pairs of blocks.

Defined cases: rows of one vec_id count their links apart if they differ, and are one component; null labels, null or empty vectors, zero vectors and vectors with null or non-finite parts link with
nothing and are their own component; vectors of different length do not link; repeated rows and copies link with each
other; rows without vec_id count as links of others but have a null component; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.jaccard import whole_groups
from pulsegrid.llm.shared import components, kept, ship
from pulsegrid.llm.words import mix, pieces, signed

COSINE, RECALL = 0.98, 0.99
SIGMA = math.sqrt(2 - 2 * COSINE)
CELL, COUNTED, WINDOW = 1.0, 24, 2.0
BLOCK, CROWD = 512, 64
#: A projection of a unit vector is kept in steps of 1 / STEPS; a window is one step wider on either side for the rounding.
STEPS = 4096
#: Pairs of points, and components of vectors, that a task handles at once.
PAIRS, CELLS = 1 << 18, 1 << 21
SEED = 20_177


def normal(z: float) -> float:
    return 0.5 * (1 + math.erf(z / math.sqrt(2)))


def needed(count: int = COUNTED, safe: float = 0.999) -> int:
    """The largest count of windows that a pair at the limit reaches with probability ``safe``."""
    p = 2 * normal(WINDOW) - 1
    tail, k = 0.0, count
    while k > 0:
        tail += math.comb(count, k) * p ** k * (1 - p) ** (count - k)
        if tail >= safe:
            return k
        k -= 1
    return 0


def layout(points: int) -> tuple[int, int]:
    """(projections per cell, tables) for so many points of one label."""
    far = sum((normal(k + 1) - normal(k)) ** 2 for k in range(-8, 8))
    near = 1 - SIGMA * math.sqrt(2 / math.pi) / CELL
    g = max(1, math.ceil(math.log(max(points, 2) / CROWD) / -math.log(far))) if points > CROWD else 1
    return g, max(1, math.ceil(math.log(1 - RECALL) / math.log(1 - near ** g)))


def _directions(dimension: int, count: int, stream: int) -> np.ndarray:
    return np.random.default_rng([SEED, dimension, stream]).standard_normal((dimension, count))


def _described(single: bool) -> Callable:
    """(vec_id, label, k1, k2, raw): digests and components of vectors that can link; null otherwise."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            ends, values = column.offsets.to_numpy().astype(np.int64), column.values
            x = values.to_numpy(zero_copy_only=False).astype(np.float64)
            bad = ~np.isfinite(x) | pc.is_null(values).to_numpy(zero_copy_only=False)
            some = np.concatenate(([0], np.cumsum(x != 0)))
            bad = np.concatenate(([0], np.cumsum(bad)))
            able = (bad[ends[1:]] == bad[ends[:-1]]) & (some[ends[1:]] > some[ends[:-1]])
            able &= column.is_valid().to_numpy(zero_copy_only=False) & batch.column("label").is_valid().to_numpy(zero_copy_only=False)
            size, keys = np.diff(ends), np.zeros((2, batch.num_rows), np.uint64)
            raws: list[bytes | None] = [None] * batch.num_rows
            for length in np.unique(size[able]):
                at = np.flatnonzero(able & (size == length))
                own = x[ends[at][:, None] + np.arange(length)]
                scaled = own / np.abs(own).max(axis=1, keepdims=True) + 0.0
                bits = mix(scaled.view(np.uint64) + np.arange(1, length + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                keys[:, at] = bits.sum(axis=1, dtype=np.uint64), np.bitwise_xor.reduce(mix(bits), axis=1)
                for i, vector in zip(at.tolist(), own.astype(np.float32) if single else own, strict=True):
                    raws[i] = vector.tobytes()
            k1, k2 = (pa.array(signed(k), pa.int64(), mask=~able) for k in keys)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), k1, k2, pa.array(raws, pa.binary())],
                                             names=["vec_id", "label", "k1", "k2", "raw"])
    return run


def _unit(raws: list[bytes], single: bool) -> np.ndarray:
    x = np.frombuffer(b"".join(raws), np.float32 if single else np.float64).reshape(len(raws), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_length(raws: list[bytes]) -> Iterator[np.ndarray]:
    """Positions of vectors of one length, so many components at a time."""
    lengths = np.array([len(r) for r in raws])
    for length in np.unique(lengths):
        at, step = np.flatnonzero(lengths == length), max(1, CELLS // max(1, int(length) // 4))
        yield from (at[i:i + step] for i in range(0, len(at), step))


def _dealt(g: int, tables: int, single: bool) -> Callable:
    """(rep, label, k1, weight, sketch, keys): the sketch of each point and its cell in each table."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, ("raw",)):
            raws = batch.column("raw").to_pylist()
            for at in _by_length(raws):
                unit = _unit([raws[i] for i in at], single)
                grid = np.floor(unit @ _directions(unit.shape[1], g * tables, 0) / CELL + np.random.default_rng(SEED).random(g * tables)).astype(np.int64)
                steps = np.clip(np.rint(unit @ _directions(unit.shape[1], COUNTED, 1) * STEPS), -32767, 32767).astype("<i2")
                part = batch.take(pa.array(at))
                label = np.asarray(part.column("label").to_numpy(), np.int64).view(np.uint64)
                keys = np.zeros((len(at), tables), np.uint64)
                for t in range(tables):
                    key = mix(mix(mix(label) + np.uint64(len(raws[at[0]]))) + np.uint64(t))
                    for c in range(t * g, t * g + g):
                        key = mix(key + grid[:, c].view(np.uint64) * np.uint64(0xABC98388FB8FAC03))
                    keys[:, t] = key
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(at) * tables + 1, tables, dtype=np.int32)), pa.array(signed(keys.reshape(-1))))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("rep", "label", "k1", "weight")), pa.array([s.tobytes() for s in steps], pa.binary()), lists],
                    names=["rep", "label", "k1", "weight", "sketch", "keys"])
    return run


def collisions(sketch: np.ndarray, group: np.ndarray, left: np.ndarray, right: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (left row, right row) of a group whose windows collide in at least so many projections.

    Rows come in order of their groups. Each projection is sorted once for all groups, since a group's values have a range
    of their own; the right rows inside the window around each left row's value are counted per pair.
    """
    at_left, at_right = np.flatnonzero(left), np.flatnonzero(right)
    members = np.bincount(group[at_right], minlength=int(group[-1]) + 1)
    begin, width = np.cumsum(members) - members, members[group[at_left]]
    base = np.cumsum(width) - width
    counts = np.zeros(int(width.sum()), np.int8)
    reach = math.ceil(WINDOW * SIGMA * STEPS) + 1
    for j in range(sketch.shape[1]):
        value = (group.astype(np.int64) << 18) + (1 << 17) + sketch[:, j]
        order = np.argsort(value[at_right], kind="stable")
        line = value[at_right][order]
        low = np.searchsorted(line, value[at_left] - reach, "left")
        found = np.searchsorted(line, value[at_left] + reach, "right") - low
        own = np.repeat(np.arange(len(at_left)), found)
        hit = order[np.arange(len(own)) + (low - np.cumsum(found) + found)[own]]
        # A pair is found once in a projection, so no position occurs twice.
        counts[(base - begin[group[at_left]])[own] + hit] += 1
    pair = np.flatnonzero(counts >= least)
    x = np.searchsorted(base, pair, "right") - 1
    return at_left[x], at_right[pair - base[x] + begin[group[at_left[x]]]]


def _pairs(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, group of each row, x, y): some whole blocks of cells and the pairs that collide there and in no earlier table."""
    for table, cut in whole_groups(batches, ["cell", "i", "j"]):
        chunk, i, j, number = (table.column(c).to_numpy() for c in ("chunk", "i", "j", "number"))
        left, right = chunk == i, chunk == j
        group = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
        size = np.bincount(group[left], minlength=len(cut) - 1) * np.bincount(group[right], minlength=len(cut) - 1)
        ahead, at = np.concatenate(([0], np.cumsum(size))), 0
        while at < len(size):
            to = max(at + 1, int(np.searchsorted(ahead, ahead[at] + PAIRS, "right")) - 1)
            rows = slice(cut[at], cut[to])
            part = table.slice(cut[at], cut[to] - cut[at]).combine_chunks()
            sketch = np.frombuffer(b"".join(part.column("sketch").to_pylist()), "<i2").reshape(part.num_rows, -1).astype(np.int64)
            x, y = collisions(sketch, group[rows] - at, left[rows], right[rows], least)
            keep = (x < y) | (i[rows][x] != j[rows][x])
            x, y = x[keep], y[keep]
            keys = pa.concat_arrays(part.column("keys").chunks)
            values, first = keys.flatten().to_numpy(), np.concatenate(([0], np.cumsum(pc.list_value_length(keys).to_numpy())))
            for earlier in range(int(number[rows].max()) if len(x) else 0):
                other = number[rows][x] <= earlier
                other[~other] = values[first[x[~other]] + earlier] != values[first[y[~other]] + earlier]
                x, y = x[other], y[other]
            yield part, group[rows] - at, x, y
            at = to


BLOCK_COLUMNS = ["cell", "i", "j", "chunk", "number", "rep", "label", "k1", "weight", "keys", "sketch"]
BLOCK_SCHEMA = "cell long, i int, j int, chunk int, number int, rep long, label long, k1 long, weight long, keys array<long>, sketch binary"


def _survivors(least: int) -> Callable:
    """The rows of each block that collide with another one there."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, x, y in _pairs(batches, least):
            stay = np.union1d(x, y)
            yield from part.select(BLOCK_COLUMNS).take(pa.array(stay, pa.int64())).combine_chunks().to_batches()
    return run


def _collided(least: int, single: bool) -> Callable:
    """(a, b, label, k1, links): rows with b tell that a and b are connected, those without are sums of linked vectors of a point."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, x, y in _pairs(batches, least):
            raws, near = part.column("raw").to_pylist(), np.zeros(len(x), bool)
            lengths = np.array([len(r) for r in raws])
            for length in np.unique(lengths[x]):
                at = np.flatnonzero(lengths[x] == length)
                step = max(1, CELLS // int(length))
                used, place = np.unique(np.concatenate((x[at], y[at])), return_inverse=True)
                unit = _unit([raws[k] for k in used], single)
                for k in range(0, len(at), step):
                    p, q = place[:len(at)][k:k + step], place[len(at):][k:k + step]
                    near[at[k:k + step]] = np.einsum("ij,ij->i", unit[p], unit[q]) >= COSINE
            x, y = x[near], y[near]
            rep, weight = part.column("rep").to_numpy(), part.column("weight").to_numpy()
            total = np.zeros(part.num_rows, np.int64)
            np.add.at(total, x, weight[y])
            np.add.at(total, y, weight[x])
            hit, root = np.flatnonzero(total), _roots(x, y, part.num_rows)
            hung = np.flatnonzero(root != np.arange(part.num_rows))
            names, none = ["a", "b", "label", "k1", "links"], pa.nulls(len(hung), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(rep[hit]), pa.nulls(len(hit), pa.int64()), *(
                pa.array(part.column(c).to_numpy()[hit]) for c in ("label", "k1")), pa.array(total[hit])], names=names)
            yield pa.RecordBatch.from_arrays([pa.array(rep[hung]), pa.array(rep[root[hung]]), none, none, none], names=names)
    return run


def _roots(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the smallest one that pairs (x, y) connect it with."""
    root = np.arange(n)
    while True:
        least = root.copy()
        np.minimum.at(least, root[x], root[y])
        np.minimum.at(least, root[y], root[x])
        least = least[root]
        while (least[least] != least).any():
            least = least[least]
        if (least == root).all():
            return root
        root = least


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label)."""
    ship(vectors.sparkSession)
    kind = vectors.schema["embedding"].dataType.simpleString()
    if not kind.startswith("array<"):
        raise TypeError(f"embedding must be an array, not {kind}")
    single = kind == "array<float>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("long").alias("label"))
    members = kept(rows.mapInArrow(_described(single), "vec_id long, label long, k1 long, k2 long, raw binary"), "vectors-rows")
    able = members.filter("k1 is not null")
    points = kept(able.groupBy("label", "k1", "k2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("raw").alias("raw")), "vectors-points")
    largest = points.groupBy("label").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    g, tables = layout(largest)
    dealt = kept(points.filter("rep is not null").mapInArrow(
        _dealt(g, tables, single), "rep long, label long, k1 long, weight long, sketch binary, keys array<long>"), "vectors-keys")
    entries = dealt.select("*", F.posexplode("keys").alias("number", "cell"))
    crowd = dealt.select(F.explode("keys").alias("cell")).groupBy("cell").count().filter("count > 1").select(
        "cell", F.ceil(F.col("count") / BLOCK).cast("int").alias("chunks"))
    placed = entries.join(crowd, "cell").withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    blocks = placed.withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other"), "keys": F.expr("slice(keys, 1, number)")})
    whole = lambda df: df.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    close = kept(whole(blocks.select(BLOCK_COLUMNS)).mapInArrow(_survivors(needed()), BLOCK_SCHEMA), "vectors-close")
    found = kept(whole(close.join(points.select("rep", "label", "k1", "raw"), ["rep", "label", "k1"])).mapInArrow(
        _collided(needed(), single), "a long, b long, label long, k1 long, links long"), "vectors-links")
    links = found.filter("b is null").groupBy(F.col("a").alias("rep"), "label", "k1").agg(F.sum("links").alias("links"))
    roots = components(found.filter("b is not null").select("a", "b"))
    classes = points.select("k1", "k2", "label", "rep", "weight").join(links, ["rep", "label", "k1"], "left").join(
        roots, F.col("rep") == F.col("node"), "left").select(
        "k1", "k2", "label", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("class_links"), F.coalesce("root", "rep").alias("class_root"))
    out = members.select("vec_id", "k1", "k2", "label").join(classes, ["k1", "k2", "label"], "left").select(
        "vec_id", F.coalesce("class_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("class_root", "vec_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
