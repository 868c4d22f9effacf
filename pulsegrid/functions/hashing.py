"""Hashes any engine with MD5 can reproduce, so splits and samples can be checked outside Spark."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(*keys: Column | str, seed: int = 0) -> Column:
    """Hex MD5 of the seed and the keys."""
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in columns]))


def bucket_of(hex_digest: Column, buckets: int) -> Column:
    """Even bucket number from the first 32 bits of a digest."""
    return (F.conv(F.substring(hex_digest, 1, 8), 16, 10).cast("bigint") % buckets).cast("int")
