from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_grouped(rows: DataFrame, per_group: DataFrame, on: list[str], how: str = "left", few: bool = False) -> DataFrame:
    """Attach one row per group to the rows of the group; null is a group of its own.

    The adaptive join broadcasts a group table that turns out small and splits a group with most of the rows otherwise, but
    by then the rows are shuffled, all of a group to one partition. ``few`` says that the groups are bounded, such as the
    models of a figure: their table is broadcast from the start and the rows stay in the tasks that read them.
    """
    renamed = per_group.withColumnsRenamed({c: f"_group_{c}" for c in on})
    renamed = F.broadcast(renamed) if few else renamed
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_group_{c}")) for c in on])
    return rows.join(renamed, same, how).drop(*[f"_group_{c}" for c in on])
