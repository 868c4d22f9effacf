"""Near-duplicate documents by n-gram Jaccard similarity with count-vector R-trees.

A document is the set of hashes of its distinct 5-word shingles. Two documents link when
``100 * |A ∩ B| >= 80 * |A ∪ B|``, which is the same as ``180 * |A ∩ B| >= 80 * (|A| + |B|)``.

Hashes are dealt to groups, and the counts per group are a document's point. For any two points the sum of the smaller
coordinates bounds the overlap from above; with the largest coordinates of a tree node in place of a point it bounds the
overlap with every document below the node. One tree over all texts would not scale: random texts of a size lie in one
ball of the count space and nearly every node passes. So the root level is cut finely: a document enters the cells of
its ``|A| - ceil(0.8 |A|) + 1`` rarest shingles (rarity: the counts of 2**18 hash groups over all documents, any fixed
order is exact). Linked documents share at least one cell. Within a cell of different texts:

1. every member is compared with one pivot (its most frequent one over its cells), and links are contracted;
2. cells of one pivot are one neighbourhood; those that still hold several components get R-trees, members outside the
   largest component search them, and each is compared with its nearest point of another component; links are
   contracted again;
3. the same search, now with every pair in different components that passes the bound.

All comparisons are exact. A pair in one component needs none, so groups of copies stay linear. Hot neighbourhoods are
split by member and dealt to blocks of at most ``BLOCK`` points on either side, so no task gets a whole one. Equal sets are one point from the start.

Defined cases: a null or empty text has an empty set, links with nothing and is its own component; with fewer than five
words the whole sequence is the only shingle; rows without doc_id link with nothing and have a null component; repeated
rows are one point; documents of equal id and different text are points of their own that report one id; columns other
than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.shared import components, kept, near_members, ship, split_join, without_keys
from pulsegrid.llm.words import mix, pieces, shingle_sets, signed, words_of

WIDTH, PERCENT = 5, 80
GROUPS, FULL = 256, 255
RARITY_BITS, SLICES = 18, 16
BLOCK, LEAF = 512, 16
#: Neighbourhoods above so many members are dealt to several tasks before they are cut into blocks.
HOT = 512
POINT_SCHEMA = "doc_id long, n long, k1 long, k2 long, point binary, slice int, tally binary"


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    if not len(shingles):
        return 0, 0
    a = mix(shingles ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64) + np.uint64(len(shingles))
    b = np.bitwise_xor.reduce(mix(shingles + np.uint64(0xE7037ED1A0B428DB)))
    return int(signed(mix(np.array([a])))[0]) & -2, int(signed(np.array([b]))[0])


def _points(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, then this partition's counts of the hash groups in slices."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()),
                        ("point", pa.binary()), ("slice", pa.int32()), ("tally", pa.binary())])
    tally = np.zeros(1 << RARITY_BITS, np.int64)
    for piece in pieces(batches):
        sets = list(shingle_sets(words_of(piece.column("text"), lower=True), WIDTH))
        keys = [_digest(s) for s in sets]
        points = [np.minimum(np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=GROUPS), FULL).astype(np.uint8).tobytes() for s in sets]
        tally += np.bincount((np.concatenate(sets) & np.uint64((1 << RARITY_BITS) - 1)).astype(np.int64), minlength=1 << RARITY_BITS)
        none = [None] * len(sets)
        yield pa.RecordBatch.from_arrays([
            piece.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([k[0] for k in keys], pa.int64()),
            pa.array([k[1] for k in keys], pa.int64()), pa.array(points, pa.binary()), pa.array(none, pa.int32()),
            pa.array(none, pa.binary())], schema=schema)
    if tally.any():
        none = [None] * SLICES
        yield pa.RecordBatch.from_arrays([
            pa.array(none, pa.int64()), pa.array(none, pa.int64()), pa.array(none, pa.int64()), pa.array(none, pa.int64()),
            pa.array(none, pa.binary()), pa.array(range(SLICES), pa.int32()),
            pa.array([part.astype(np.uint32).tobytes() for part in np.split(tally, SLICES)], pa.binary())], schema=schema)


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices added up within a partition."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = np.frombuffer(blob, np.uint32).astype(np.int64)
            sums[k] = sums[k] + part if k in sums else part
    if sums:
        yield pa.RecordBatch.from_arrays([
            pa.array(list(sums), pa.int32()),
            pa.array([np.minimum(v, 0xFFFFFFFF).astype(np.uint32).tobytes() for v in sums.values()], pa.binary())], names=["slice", "tally"])


def rarity(points: DataFrame) -> np.ndarray:
    """Counts of the hash groups over all documents: a table of fixed size, 1 MB."""
    parts = points.filter("slice is not null").select("slice", "tally")
    added = parts.mapInArrow(_added, "slice int, tally binary").repartition(SLICES, "slice").mapInArrow(_added, "slice int, tally binary")
    table = np.zeros((SLICES, (1 << RARITY_BITS) // SLICES), np.uint32)
    for row in added.collect():
        table[row.slice] = np.frombuffer(row.tally, np.uint32)
    return table.reshape(-1)


def _cells(table) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = table.value
        for piece in pieces(batches):
            tokens, keys = [], []
            for s in shingle_sets(words_of(piece.column("text"), lower=True), WIDTH):
                if not len(s):
                    continue
                take, early = len(s) - (PERCENT * len(s) + 99) // 100 + 1, len(s) - -(-160 * len(s) // 180) + 1
                order = np.argsort(counts[(s & np.uint64((1 << RARITY_BITS) - 1)).astype(np.int64)], kind="stable")[:take]
                tokens.append(s[order])
                keys.append((_digest(s)[0] & -2) | (np.arange(take) >= early))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(np.concatenate(tokens))), pa.array(np.concatenate(keys))], names=["token", "entry"])
    return run


def _linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact comparison of pairs of texts; a text whose set is not the one asked for is another row of the same id."""
    for piece in pieces(batches, ("text_a", "text_b")):
        left = shingle_sets(words_of(piece.column("text_a"), lower=True), WIDTH)
        right = shingle_sets(words_of(piece.column("text_b"), lower=True), WIDTH)
        a, b = piece.column("a").to_pylist(), piece.column("b").to_pylist()
        hit = []
        for i, (x, y) in enumerate(zip(left, right, strict=True)):
            if 180 * min(len(x), len(y)) < PERCENT * (len(x) + len(y)) or _digest(x)[0] != a[i] or _digest(y)[0] != b[i]:
                continue
            if 180 * len(np.intersect1d(x, y, assume_unique=True)) >= PERCENT * (len(x) + len(y)):
                hit.append(i)
        yield pa.RecordBatch.from_arrays([piece.column("rep_a").take(pa.array(hit, pa.int64())), piece.column("rep_b").take(pa.array(hit, pa.int64()))], names=["a", "b"])


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows in tables of whole groups, with the bounds of the groups."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
        cut = _bounds(table, keys)
        rest = table.slice(cut[-2])
        if cut[-2]:
            yield table.slice(0, cut[-2]), cut[:-1]
    if rest is not None:
        yield rest, np.array([0, rest.num_rows])


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows - 1, bool)
    for key in keys:
        values = table.column(key).to_numpy()
        new |= values[1:] != values[:-1]
    return np.concatenate(([0], np.flatnonzero(new) + 1, [table.num_rows]))


class Tree:
    """A packed R-tree of count points, sorted by size and then by counts; a node keeps its largest coordinates and least size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        self.order = np.lexsort((*points.T[::-1], sizes))
        top, least = points[self.order], sizes[self.order]
        self.levels = [(top, least)]
        while len(top) > LEAF:
            at = np.arange(0, len(top), LEAF)
            top, least = np.maximum.reduceat(top, at), np.minimum.reduceat(least, at)
            self.levels.append((top, least))

    def search(self, point: np.ndarray, size: int) -> np.ndarray:
        """Positions of points whose overlap with the query may reach the similarity."""
        at = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            top, least = self.levels[depth]
            bound = np.minimum(top[at], point).sum(axis=1)
            at = at[180 * bound >= PERCENT * (size + least[at])]
            if depth:
                at = (at[:, None] * LEAF + np.arange(LEAF)).reshape(-1)
                at = at[at < len(self.levels[depth - 1][0])]
        return self.order[at]


def _searched(nearest: bool) -> Callable:
    """Pairs (a, b, score) in different components that may link; with ``nearest`` only the best answer of each query.

    Of two linked documents the smaller one holds the rarest shared shingle among its first, so it must not be late.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cut in whole_groups(batches, ["pivot", "i", "j"]):
            asks, keys, late = table.column("asks").to_numpy(), table.column("k1").to_numpy(), table.column("late").to_numpy()
            sizes, labels = table.column("n").to_numpy(), table.column("label").to_numpy()
            points = np.frombuffer(b"".join(table.column("point").to_pylist()), np.uint8).reshape(-1, GROUPS).astype(np.int32)
            points[points == FULL] = 1 << 22
            found = [np.zeros((3, 0), np.int64)]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                ask, ans = a + np.flatnonzero(asks[a:b]), a + np.flatnonzero(~asks[a:b])
                if not len(ask) or not len(ans):
                    continue
                tree = Tree(points[ans], sizes[ans])
                for q in ask:
                    near = ans[tree.search(points[q], sizes[q])]
                    near = near[(labels[near] != labels[q]) & np.where(sizes[near] < sizes[q], ~late[near], (sizes[near] == sizes[q]) & ~late[near] | ~late[q])]
                    if len(near):
                        score = 1000 * np.minimum(points[near], points[q]).sum(axis=1, dtype=np.int64) // (sizes[near] + sizes[q])
                        if nearest:
                            near, score = near[[score.argmax()]], score[[score.argmax()]]
                            found.append(np.stack([np.full(1, keys[q]), keys[near], score]))
                        else:
                            found.append(np.stack([np.minimum(keys[near], keys[q]), np.maximum(keys[near], keys[q]), score]))
            both = np.unique(np.concatenate(found, axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1]), pa.array(both[2])], names=["a", "b", "score"])
    return run


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    side = lambda x: texts.select(F.col("k1").alias(x), F.col("rep").alias(f"rep_{x}"), F.col("text").alias(f"text_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_linked, "a long, b long")


def _unfinished(near: DataFrame, labels: DataFrame, hot: DataFrame) -> DataFrame:
    """Rows (pivot, i, j, asks, k1, late, n, label, point) of neighbourhoods that hold several components, dealt to bounded blocks."""
    rows = near.join(labels, "k1")
    tallies = rows.groupBy("pivot", "label").agg(F.count("*").alias("c"))
    mixed = tallies.groupBy("pivot").agg(
        F.sum("c").alias("members"), F.max(F.struct("c", "label")).alias("main"), F.count("*").alias("kinds")).filter("kinds > 1")
    mixed = mixed.select(
        "pivot", F.col("main.label").alias("main"), F.ceil(F.col("members") / BLOCK).cast("int").alias("answers"),
        F.ceil((F.col("members") - F.col("main.c")) / BLOCK).cast("int").alias("askers"))
    dealt = split_join(rows, mixed, "pivot", hot, F.col("k1")).withColumns({
        "own_i": F.pmod(F.xxhash64("k1"), F.col("askers")).cast("int"), "own_j": F.pmod(F.xxhash64("k1", F.lit(1)), F.col("answers")).cast("int")})
    columns = ["pivot", "k1", "late", "n", "label", "point"]
    asks = dealt.filter("label <> main").select(
        *columns, F.col("own_i").alias("i"), F.explode(F.sequence(F.lit(0), F.col("answers") - 1)).alias("j"), F.lit(True).alias("asks"))
    answers = dealt.select(
        *columns, F.explode(F.sequence(F.lit(0), F.col("askers") - 1)).alias("i"), F.col("own_j").alias("j"), F.lit(False).alias("asks"))
    return asks.unionByName(answers)


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    points = kept(docs.mapInArrow(_points, POINT_SCHEMA), "jaccard-points")
    table = spark.sparkContext.broadcast(rarity(points))
    members = points.filter("slice is null").select("doc_id", "n", "k1", "k2")
    reps = kept(points.filter("n > 0 and doc_id is not null").groupBy("k1", "k2", "n").agg(
        F.min("doc_id").alias("rep"), F.first("point").alias("point")), "jaccard-sets")

    # An entry is the key of a set; its lowest bit tells that the shingle is not among the first of the document.
    tokens = docs.filter("doc_id is not null").mapInArrow(_cells(table), "token long, entry long")
    shared = tokens.groupBy("token").agg(
        F.min(F.expr("entry & -2L")).alias("least"), F.max(F.expr("entry & -2L")).alias("most"),
        F.min(F.when(F.expr("entry & 1L") == 0, F.col("entry"))).alias("pivot")).filter("least <> most and pivot is not null")
    # Cells of one pivot are one neighbourhood: a document stands there once, however many of the cells it is in.
    near = kept(tokens.join(shared.select("token", "pivot"), "token").groupBy("pivot", F.expr("entry & -2L").alias("k1")).agg(
        F.count("*").alias("cells"), F.min(F.expr("entry & 1L") == 1).alias("late")), "jaccard-near")

    hot = kept(near.groupBy("pivot").count().filter(F.col("count") > HOT).select("pivot"), "jaccard-hot")
    wanted = near.select("k1").distinct().join(reps, "k1").select("k1", "rep")
    texts = kept(near_members(docs, "doc_id", wanted.select(F.col("rep").alias("doc_id"))).join(
        wanted.withColumnRenamed("rep", "doc_id"), "doc_id").select("k1", F.col("doc_id").alias("rep"), "text"), "jaccard-texts")

    stars = near.filter("k1 <> pivot").groupBy("k1").agg(
        F.max(F.struct("cells", "pivot")).alias("best")).select(F.col("k1").alias("a"), F.col("best.pivot").alias("b"))
    first = kept(_verified(stars, texts), "jaccard-links")
    roots = components(first)

    links = first
    for nearest in (True, False):
        labels = reps.join(roots, F.col("rep") == F.col("node"), "left").select(
            "k1", "n", "point", F.coalesce("root", "rep").alias("label"))
        blocks = _unfinished(near, labels, hot).repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j")
        found = blocks.mapInArrow(_searched(nearest), "a long, b long, score long")
        if nearest:
            pairs = found.groupBy("a").agg(F.max(F.struct("score", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
        else:
            pairs = found.select("a", "b").distinct()
        links = links.unionByName(kept(_verified(kept(pairs, "jaccard-pairs"), texts), "jaccard-links"))
        roots = components(links)

    named = reps.join(roots, F.col("rep") == F.col("node"), "left").select(
        "k1", "k2", "n", F.coalesce("root", "rep").alias("class_root"))
    return members.join(named, ["k1", "k2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_root", "doc_id")).alias("component_id"))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows whose doc_id is the smallest of its group, with all columns; rows without doc_id stay, and so do rows
    that repeat a doc_id that stays.
    """
    found = jaccard_components(docs).filter("doc_id is not null").groupBy("doc_id").agg(F.min("component_id").alias("root"))
    gone = kept(found.filter("doc_id <> root").select("doc_id"), "jaccard-copies")
    return without_keys(docs, "doc_id", gone)
