from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.hashing import digest

# Shares of the three parts and the seed of the split.
SPLIT_SHARES = (0.70, 0.15, 0.15)
SPLIT_SEED = 11
SPLIT_NAMES = ("train", "val", "test")


def random_split(df: DataFrame, shares: tuple[float, ...] = SPLIT_SHARES, seed: int = SPLIT_SEED) -> list[DataFrame]:
    """Row-wise split by Spark's sampler; repeatable only while the input keeps its partitions and order."""
    return df.randomSplit(list(shares), seed)


def with_random_split(df: DataFrame, shares: tuple[float, ...] = SPLIT_SHARES, seed: int = SPLIT_SEED) -> DataFrame:
    """Name of the part each row is drawn for, in one column: written partitioned by it, the rows are scanned once."""
    drawn = F.rand(seed)
    part = F.lit(SPLIT_NAMES[-1])
    for i, name in reversed(list(enumerate(SPLIT_NAMES[:-1]))):
        part = F.when(F.col("_drawn") < sum(shares[: i + 1]), name).otherwise(part)
    return df.withColumn("_drawn", drawn).withColumn("split", part).drop("_drawn")


def with_split(df: DataFrame, keys: list[str], shares: tuple[float, ...] = SPLIT_SHARES,
               seed: int = SPLIT_SEED) -> DataFrame:
    """Name of the part each row belongs to, from a digest of its keys.

    No shuffle, and the same rows whatever the layout of the input. Splitting on a group key such as the case
    keeps all rows of a group in one part.
    """
    # The first 32 bits of the digest against fractional edges: shares far below one percent get their rows.
    bucket = F.conv(F.substring(digest(*keys, seed=seed), 1, 8), 16, 10).cast("bigint")
    edges = [round(2**32 * sum(shares[: i + 1])) for i in range(len(shares) - 1)]
    part = F.lit(SPLIT_NAMES[-1])
    for name, edge in reversed(list(zip(SPLIT_NAMES, edges))):
        part = F.when(bucket < edge, name).otherwise(part)
    return df.withColumn("split", part)


def hash_split(df: DataFrame, keys: list[str], shares: tuple[float, ...] = SPLIT_SHARES,
               seed: int = SPLIT_SEED) -> list[DataFrame]:
    marked = with_split(df, keys, shares, seed)
    return [marked.filter(F.col("split") == name).drop("split") for name in SPLIT_NAMES]


def capped_sample(df: DataFrame, rows: int, keys: list[str], seed: int = 42) -> DataFrame:
    """At most ``rows`` rows in seeded random order, the same ones whatever the layout of the input.

    A table of row counts per leading 16 bits of the digest tells where the sample ends. Rows behind that point are
    dropped while scanning, so the final top-k sees hardly more than the sample even when there are very many tasks.
    """
    marked = df.withColumn("_digest", digest(*keys, seed=seed))
    marked = marked.withColumn("_prefix", F.substring("_digest", 1, 4))
    # At most 65536 rows.
    counts = marked.groupBy("_prefix").agg(F.count("*").alias("_rows"))
    so_far = F.sum("_rows").over(Window.orderBy("_prefix"))
    last = counts.select("_prefix", so_far.alias("_so_far")).agg(
        F.min(F.when(F.col("_so_far") >= rows, F.col("_prefix"))).alias("last")).scalar()
    nearest = marked.filter(F.col("_prefix") <= F.coalesce(last, F.lit("ffff")))
    return nearest.orderBy("_digest", *keys).limit(rows).drop("_digest", "_prefix")
