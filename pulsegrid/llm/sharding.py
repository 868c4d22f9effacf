"""Sharding by best-fit-decreasing bin packing of indivisible groups.

A group is all documents of equal text; its size is the sum of its rows' sizes. Best fit takes the groups by falling size and
puts each into the bin with the tightest remaining capacity that holds it; the bins stand in a balanced tree by remaining
capacity. Groups of equal size are interchangeable, so the driver packs classes: a size and the number of its groups. A bin
that took a group of a class is again the tightest for the next one as long as that fits, so a class is a few runs of groups,
each in one bin. The number of different sizes is at most the square root of twice the bytes, whatever the number of groups.
Groups are ranked within their class in parallel and find their run by size and rank.

``packed`` opens bins of a given capacity as needed; ``capacity_for`` finds the smallest capacity for which a wanted number of
bins suffices, which makes their sizes near equal.

Defined cases: a null text has no bytes and is grouped with empty texts; repeated rows are members of their group and
get slots of their own; rows without doc_id are placed like others; with fewer groups than shards some shards are empty;
no rows give no shards; other columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.shared import kept

#: Groups of at least this part of all bytes find their shard by broadcast, since their rows may be many; so many at most.
HEAVY = 4096


class Bins:
    """Bins (remaining capacity, number) in order, in a balanced tree: a treap whose priorities are a digest of the number."""

    def __init__(self) -> None:
        self.root: list | None = None

    def put(self, left: int, number: int) -> None:
        low, high = self._split(self.root, (left, number))
        # Fixed value: a multiplier that scatters the numbers over 64 bits.
        node = [(left, number), (number + 1) * 0x9E3779B97F4A7C15 % (1 << 64), None, None]
        self.root = self._joined(self._joined(low, node), high)

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the bin with the tightest remaining capacity that holds ``size``."""
        low, high = self._split(self.root, (size, -1))
        node = high
        while node and node[2]:
            node = node[2]
        if node:
            _, high = self._split(high, (node[0][0], node[0][1] + 1))
        self.root = self._joined(low, high)
        return node[0] if node else None

    def _split(self, node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
        if node is None:
            return None, None
        if node[0] < key:
            node[3], high = self._split(node[3], key)
            return node, high
        low, node[2] = self._split(node[2], key)
        return low, node

    def _joined(self, a: list | None, b: list | None) -> list | None:
        if a is None or b is None:
            return a or b
        if a[1] >= b[1]:
            a[3] = self._joined(a[3], b)
            return a
        b[2] = self._joined(a, b[2])
        return b


def runs(classes: dict[int, int], capacity: int, most: int | None = None) -> tuple[list[tuple[int, int, int, int]], int]:
    """((size, first, end, bin), …) and the number of bins for classes (size to number of groups).

    A group above the capacity gets a bin to itself. Stops when more than ``most`` bins are open.
    """
    bins, out, opened = Bins(), [], 0
    for size in sorted(classes, reverse=True):
        first, count = 0, classes[size]
        while first < count:
            left, number = bins.take(size) or (max(capacity, size), opened)
            opened = max(opened, number + 1)
            if most is not None and opened > most:
                return out, opened
            some = min(count - first, left // size)
            out.append((size, first, first + some, number))
            first, left = first + some, left - some * size
            if left:
                bins.put(left, number)
    return out, opened


def packed(sizes: list[tuple[int, int]], capacity: int) -> dict[int, int]:
    """Bin of each item (size, item); an item above the capacity gets a bin to itself."""
    items = defaultdict(list)
    for size, item in sorted(sizes):
        items[size].append(item)
    found, _ = runs({size: len(own) for size, own in items.items()}, capacity)
    return {item: number for size, first, end, number in found for item in items[size][first:end]}


def capacity_for(sizes: list[tuple[int, int]], shards: int) -> int:
    """A capacity at which best fit needs no more than ``shards`` bins and below which it fails."""
    return capacity_of(Counter(size for size, _ in sizes), shards)


def capacity_of(classes: dict[int, int], shards: int) -> int:
    """The same for classes: growing steps from the least possible capacity on, then bisection."""
    enough = lambda capacity: runs(classes, capacity, shards)[1] <= shards
    least = max(-(-sum(s * c for s, c in classes.items()) // shards), max(classes, default=1))
    low, step = least - 1, 1
    while not enough(low + step):
        low, step = low + step, 2 * step
    high = low + step
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if enough(middle) else (middle, high)
    return high


def _size(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def shards_of(docs: DataFrame, shards: int = 16) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row; the law is ``bytes``."""
    blank = F.coalesce("text", F.lit("")).cast("binary")
    rows = kept(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _size().alias("size"), F.crc32(blank).alias("text_crc32"), F.md5(blank).alias("digest"),
        F.xxhash64("doc_id", blank).alias("spread")), "sharding-rows")
    groups = kept(rows.groupBy("digest").agg(F.sum("size").alias("group_size")), "sharding-groups")
    total = groups.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    placed = _placed_groups(groups, shards)
    heavy = F.col("group_size") * HEAVY >= total
    # At most HEAVY groups can be this large. No other group holds more than that part of the bytes.
    by_heavy = rows.join(F.broadcast(placed.filter(heavy).select("digest", F.col("shard").alias("heavy_shard"))), "digest", "left")
    light = by_heavy.filter("heavy_shard is null").join(placed.filter(~heavy).select("digest", "shard"), "digest").drop("heavy_shard")
    both = by_heavy.filter("heavy_shard is not null").withColumnRenamed("heavy_shard", "shard").unionByName(light)
    return slotted(kept(both.drop("digest"), "sharding-placed")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _placed_groups(groups: DataFrame, shards: int) -> DataFrame:
    """(digest, group_size, shard): the runs of the classes, found by size and rank within the class."""
    spark = groups.sparkSession
    cells = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    celled = groups.withColumn("cell", F.pmod(F.xxhash64("digest"), F.lit(cells)).cast("int"))
    counts = kept(celled.groupBy("group_size", "cell").count(), "sharding-classes")
    ahead = counts.select(
        "group_size", "cell", (F.sum("count").over(Window.partitionBy("group_size").orderBy("cell")) - F.col("count")).alias("ahead"))
    classes = {r.group_size: r.groups for r in counts.groupBy("group_size").agg(F.sum("count").alias("groups")).collect()}
    found, _ = runs(classes, capacity_of(classes, shards))
    # A table of the shared folder, so that its size decides how it is joined.
    where = kept(spark.createDataFrame(found, "group_size long, first long, end long, shard int"), "sharding-runs")
    own = F.row_number().over(Window.partitionBy("group_size", "cell").orderBy("digest")) - 1
    ranked = celled.withColumn("own", own).join(ahead, ["group_size", "cell"]).withColumn("place", F.col("own") + F.col("ahead"))
    return kept(ranked.join(where, "group_size").filter("place >= first and place < end").select("digest", "group_size", "shard"), "sharding-shards")


def slotted(placed: DataFrame) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each shard: numbered within cells of a shard, after the counts of the cells before.

    The number of cells follows the session's shuffle partitions, so no task numbers a whole shard.
    """
    cells = max(16, int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = placed.withColumn("cell", F.pmod("spread", F.lit(cells)).cast("int"))
    sums = rows.groupBy("shard", "cell").count()
    ahead = sums.select("shard", "cell", (F.sum("count").over(Window.partitionBy("shard").orderBy("cell")) - F.col("count")).alias("ahead"))
    own = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32")) - 1
    return rows.withColumn("own", own).join(ahead, ["shard", "cell"]).withColumn("slot", F.col("own") + F.col("ahead"))
