"""A Parquet table in parts that are replaced whole; a manifest names the version of each part.

A change writes the new parts below the number of the change and then a manifest of that number. Readers take the last
manifest whose write was completed, so they see all parts of a change or none, and open only the parts they need. A change
that is repeated starts from the manifest before it and replaces what it wrote the first time.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pulsegrid.streaming.storage import children, committed, remove

_MANIFEST = "part string, version long"


@dataclass(frozen=True)
class PartedTable:
    """``part`` names the text column that deals rows to parts; ``schema`` has the other columns."""

    spark: SparkSession
    path: str
    part: str
    schema: T.StructType

    def number(self, before: int | None = None) -> int | None:
        """Number of the last change, or of the last one before a number."""
        found = [n for n in committed(self.spark, f"{self.path}/manifest", "number=") if before is None or n < before]
        return found[-1] if found else None

    def versions(self, before: int | None = None) -> dict[str, int]:
        last = self.number(before)
        if last is None:
            return {}
        return {r.part: r.version for r in self.spark.read.schema(_MANIFEST).json(f"{self.path}/manifest/number={last}").collect()}

    def read(self, parts: Iterable[str] | None = None, before: int | None = None) -> DataFrame:
        """The rows of the chosen parts, all by default."""
        wanted = None if parts is None else set(parts)
        return self._of({p: v for p, v in self.versions(before).items() if wanted is None or p in wanted})

    def _of(self, versions: dict[str, int]) -> DataFrame:
        whole = T.StructType([*self.schema.fields, T.StructField(self.part, T.StringType())])
        if not versions:
            return self.spark.createDataFrame([], whole)
        paths = [f"{self.path}/data/version={v}/{self.part}={p}" for p, v in sorted(versions.items())]
        read = T.StructType([*whole.fields, T.StructField("version", T.LongType())])
        return self.spark.read.schema(read).option("basePath", f"{self.path}/data").parquet(*paths).select(*whole.names)

    def replace(self, rows: DataFrame, number: int) -> None:
        """Change ``number``: the parts that ``rows`` has take the place of those parts as they were before."""
        before = self.versions(before=number)
        folder = f"{self.path}/data/version={number}"
        rows.select(*self.schema.names, self.part).write.mode("overwrite").partitionBy(self.part).parquet(folder)
        now = before | dict.fromkeys(children(self.spark, folder, f"{self.part}="), number)
        manifest = self.spark.createDataFrame(sorted(now.items()), _MANIFEST)
        manifest.coalesce(1).write.mode("overwrite").json(f"{self.path}/manifest/number={number}")

    def forget_old(self) -> None:
        """Delete manifests and parts that the last manifest does not name; no reader of an earlier one may be running."""
        last, now = self.number(), self.versions()
        for n in committed(self.spark, f"{self.path}/manifest", "number="):
            if n < last:
                remove(self.spark, f"{self.path}/manifest/number={n}")
        for v in map(int, children(self.spark, f"{self.path}/data", "version=")):
            folder = f"{self.path}/data/version={v}"
            for p in children(self.spark, folder, f"{self.part}=") if v <= last else []:
                if now.get(p) != v:
                    remove(self.spark, f"{folder}/{self.part}={p}")
