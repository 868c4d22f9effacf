"""Stated query sets in blocks of bounded size, and the best few rows of many groups."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts into which the tasks' best rows of a group are dealt before the last merge.
PARTS = 64


def in_blocks(queries: DataFrame, spread: Column, size: Column, limit: int) -> tuple[DataFrame, int]:
    """``queries`` with column ``block`` and the number of blocks.

    Sizes of a block sum to at most twice the limit, unless it is one row, so a block may be collected and broadcast.
    Rows must differ in ``spread``.
    """
    total = queries.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    count = max(1, -(-total // limit))
    while True:
        dealt = queries.withColumn("block", F.pmod(F.xxhash64(spread), F.lit(count)))
        if count == 1:
            return dealt, count
        worst = dealt.groupBy("block").agg(F.sum(size).alias("size"), F.count("*").alias("rows")).filter("rows > 1").agg(F.max("size")).first()[0]
        if worst is None or worst <= 2 * limit:
            return dealt, count
        count *= 2


def merged_best(rows: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group with their ``rank`` from 1; ``rows`` hold the first k of each task and its ``task``.

    Tasks are dealt to a fixed number of parts first, so no task gets the rows that all tasks found for a group.
    """
    part = F.pmod(F.col("task"), F.lit(PARTS))
    first = rows.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy(*group, "part").orderBy(*order))).filter(F.col("rank") <= k)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("rank") <= k).drop("part", "task")


class Best:
    """The ``k`` best (score, id) of each group so far: higher scores first, then smaller ids."""

    def __init__(self, groups: int, k: int) -> None:
        self.k = k
        self.group, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        #: Scores below the bar of a full group cannot enter it.
        self.bar = np.full(groups, np.iinfo(np.int64).min)
        self._waiting: list[tuple[np.ndarray, ...]] = []
        self._count = 0

    def add(self, group: np.ndarray, score: np.ndarray, row_id: np.ndarray) -> None:
        if len(group):
            self._waiting.append((group, score, row_id))
            self._count += len(group)
            if self._count >= max(1 << 15, len(self.group)):
                self.settle()

    def settle(self) -> None:
        parts = [(self.group, self.score, self.id), *self._waiting]
        group, score, row_id = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.lexsort((row_id, -score, group))
        group, score, row_id = group[order], score[order], row_id[order]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        stay = place < self.k
        self.group, self.score, self.id = group[stay], score[stay], row_id[stay]
        full = place[stay] == self.k - 1
        self.bar[self.group[full]] = self.score[full]
        self._waiting, self._count = [], 0
