"""File inventories and the landing jobs planned from them.

An inventory is a DataFrame of ``path, file_name, size``: one row per file. Selections and copies are computed on
it with joins and running totals; file contents are only read afterwards.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.functions.hashing import digest
from pulsegrid.functions.text import base_name, case_id, safe_names
from pulsegrid.schemas import VITALS_RENAMES
from pulsegrid.streaming.storage import first_line

BYTES_PER_GB = 1024**3


def file_inventory(spark: SparkSession, root: str, pattern: str = "*fulldata*.csv") -> DataFrame:
    """Files below ``root`` whose name matches; the content column is never read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    return files.select("path", base_name(F.col("path")).alias("file_name"),
                        F.col("length").alias("size"))


def discovered_files(spark: SparkSession, root: str, name: str | None = None, folder: str | None = None,
                     suffix: str = ".csv") -> DataFrame:
    """Files at any depth below ``root`` whose name or folder holds a text, in any case; contents are not read.

    ``name`` is looked for in the file name, ``folder`` in the folders between ``root`` and the file.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    listed = files.select("path", F.col("_metadata.file_name").alias("file_name"), F.col("length").alias("size"))
    start = F.locate(root.rstrip("/"), F.col("path"))
    behind = F.when(start > 0, start + len(root.rstrip("/"))).otherwise(1)
    below = F.lower(F.regexp_replace(F.substr("path", behind), "[^/]*$", ""))
    wanted = F.lower("file_name").endswith(suffix.lower())
    if name:
        wanted = wanted & F.lower("file_name").contains(name.lower())
    if folder:
        wanted = wanted & below.contains(folder.lower())
    return listed.filter(wanted).select("path", "file_name", "size")


def selected_paths(files: DataFrame) -> list[str]:
    """Paths of chosen files for a reader; as Spark itself does, the driver holds the names of the files it plans."""
    return [r["path"] for r in files.select("path").distinct().orderBy("path").toLocalIterator()]


def inventory_summary(files: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("size"), F.lit(0))
    return files.agg(F.count("*").alias("files"), total.alias("bytes"), (total / BYTES_PER_GB).alias("gb"))


def running_size(files: DataFrame, seed: int = 42) -> DataFrame:
    """Add ``before``: bytes of all files that precede a file in a seeded shuffle.

    The shuffle orders files by an MD5 digest. Its leading bits cut the order into even buckets, so the sum runs
    inside each bucket in parallel and only one row per bucket is summed up in a single place.
    """
    shuffled = files.withColumn("_order", digest("file_name", seed=seed))
    shuffled = shuffled.withColumn("_bucket", F.conv(F.substring("_order", 1, 3), 16, 10).cast("int"))
    totals = shuffled.groupBy("_bucket").agg(F.sum("size").alias("_bucket_size"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_bucket", F.coalesce(F.sum("_bucket_size").over(earlier), F.lit(0)).alias("_offset"))
    inside = (
        Window.partitionBy("_bucket").orderBy("_order", "file_name").rowsBetween(Window.unboundedPreceding, -1)
    )
    # Three hex digits: at most 4096 offset rows, whatever the number of files.
    joined = shuffled.join(F.broadcast(offsets), "_bucket")
    before = F.col("_offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    return joined.withColumn("before", before).drop("_bucket", "_order", "_offset")


def budget_sample(files: DataFrame, target_bytes: int, seed: int = 42) -> DataFrame:
    """Files of the seeded shuffle as long as their running total stays within the budget."""
    return running_size(files, seed).filter(F.col("before") + F.col("size") <= target_bytes).drop("before")


def greedy_budget_sample(files: DataFrame, target_bytes: int, seed: int = 42) -> DataFrame:
    """Like ``budget_sample``, but a file that would overshoot is skipped and later, smaller ones still fit in.

    Files are classed by the power of two below their size, and so is the room left. While the room stays in its class,
    larger classes never fit, smaller ones always do, and the first of the same class that fits ends this, as does a sum of
    smaller files that does. Running sums of the smaller files tell where that happens, so the room falls by a class in each
    round: at most one round per bit of the budget. A round gives the driver one row; the result is one filter.
    """
    ordered = files.withColumn("_place", F.struct(digest("file_name", seed=seed), "file_name"))
    listed = ordered.persist()
    room, behind, taken = target_bytes, F.lit(True), F.col("size") <= 0
    while room > 0:
        base = 1 << (room.bit_length() - 1)
        small, same = F.col("size") < base, (F.col("size") >= base) & (F.col("size") <= room)
        sums = running_size(listed.filter(behind & (F.col("size") > 0) & (small | same)).withColumns(
            {"_whole": F.col("size"), "size": F.when(small, F.col("size")).otherwise(0)}), seed)
        left = F.lit(room) - F.col("before") - F.col("_whole")
        turns = F.when(F.col("size") > 0, left < base).otherwise(left >= 0)
        stop = sums.filter(turns).agg(F.min(F.struct("_place", left.alias("left"))).alias("stop")).first()["stop"]
        if stop is None:
            taken = taken | (behind & small)
            break
        place = F.struct(*[F.lit(v) for v in stop["_place"]])
        taken = taken | (behind & small & (F.col("_place") < place)) | (F.col("_place") == place)
        room, behind = stop["left"], F.col("_place") > place
    listed.unpersist()
    return ordered.filter(taken).drop("_place")


def rows_of_files(rows: DataFrame, files: DataFrame, file_column: str = "case_name") -> DataFrame:
    """Rows that come from the selected files."""
    names = files.select(F.col("file_name").alias(file_column))
    return rows.join(names, file_column, "left_semi")


def planned_copies(files: DataFrame, target_bytes: int, seed: int = 42) -> DataFrame:
    """Number of whole-file copies per file that brings the data set up to the target size.

    Copies go round by round in shuffle order and stop with the first one that reaches the target.
    """
    total = files.agg(F.sum("size").alias("total")).scalar()
    return (
        running_size(files, seed)
        .withColumn("_total", total)
        .withColumn("_missing", F.lit(target_bytes) - F.col("_total") - F.col("before"))
        .withColumn("copies", F.greatest(F.lit(0), F.ceil(F.col("_missing") / F.col("_total"))).cast("int"))
        .drop("before", "_total", "_missing")
    )


def replicated_files(files: DataFrame, target_bytes: int, seed: int = 42) -> DataFrame:
    """Originals (copy 0) and their copies under the names they get."""
    plan = planned_copies(files, target_bytes, seed)
    numbered = plan.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies")))).drop("copies")
    return numbered.withColumn("source_name", F.col("file_name")).withColumn("file_name", _copy_name("file_name"))


def replicate_rows(rows: DataFrame, files: DataFrame, target_bytes: int, seed: int = 42,
                   file_column: str = "case_name") -> DataFrame:
    """Rows of the data set after replication.

    The join carries each original row once and multiplies it afterwards. No broadcast is forced: the plan grows
    with the number of files, and a file with a large share of the rows is split by the adaptive skew join.
    """
    plan = planned_copies(files, target_bytes, seed).select(F.col("file_name").alias(file_column), "copies")
    joined = rows.join(plan, file_column)
    numbered = joined.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies")))).drop("copies")
    return numbered.withColumn(file_column, _copy_name(file_column)).drop("copy")


def _copy_name(column: str) -> Column:
    renamed = F.concat(F.lit("copy"), F.col("copy").cast("string"), F.lit("_"), F.col(column))
    return F.when(F.col("copy") > 0, renamed).otherwise(F.col(column))


def not_landed(files: DataFrame, landed: DataFrame) -> DataFrame:
    """Files whose name is not in the target yet."""
    return files.join(landed.select("file_name").distinct(), "file_name", "left_anti")


def landing_report(files: DataFrame, landed: DataFrame) -> DataFrame:
    """How many files a landing run copies and how many it skips, in one pass over the inventory."""
    marks = landed.select("file_name").distinct().withColumn("_landed", F.lit(True))
    joined = files.join(marks, "file_name", "left")
    return joined.agg(
        F.count_if(F.col("_landed").isNull()).alias("copied"),
        F.count_if(F.col("_landed").isNotNull()).alias("skipped"),
    )


def landing_check(files: DataFrame) -> DataFrame:
    """What lies in a folder: files, size, number of cases, first and last case by number, however many digits they have."""
    case = F.nullif(F.when(F.lower("file_name").contains("fulldata"), case_id(F.col("file_name"))), F.lit(""))
    digits = F.ltrim(case, F.lit("0"))
    number = F.when(case.isNotNull(), F.struct(F.length(digits).alias("length"), digits.alias("digits"), case.alias("case")))
    return files.agg(
        F.count("*").alias("files"),
        (F.coalesce(F.sum("size"), F.lit(0)) / BYTES_PER_GB).alias("gb"),
        F.count_distinct(case).alias("cases"),
        F.min(number)["case"].alias("first_case"),
        F.max(number)["case"].alias("last_case"),
    )


def land_new_files(spark: SparkSession, source: str, target: str, checkpoint: str, schema: T.StructType,
                   pattern: str = "*fulldata*.csv", quarantine: str | None = None, files_per_batch: int = 1000) -> StreamingQuery:
    """Append recording files not seen before to a Parquet table; progress is kept in the checkpoint folder.

    The stream sees names only. The header line of each new file, at most ``files_per_batch`` at once, is compared with the
    schema: a file whose columns differ or stand in another order is noted in ``quarantine`` (path, header, reason) and
    left where it is, and the others land. Without a quarantine such a file ends the stream with an error. A repeated batch
    replaces what it wrote.
    """
    stream = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    names = stream.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).load(source).select("path")
    expected = ",".join(schema.names)

    def land(batch: DataFrame, batch_id: int) -> None:
        headers = {r.path: first_line(spark, r.path) for r in batch.collect()}
        odd = {p: h for p, h in headers.items() if header_columns(h) != schema.names}
        if odd and not quarantine:
            raise ValueError(f"other columns than {expected}: {sorted(odd)}")
        if odd:
            noted = [(p, h, "no header" if not h else "other columns" if set(header_columns(h)) != set(schema.names) else "other order") for p, h in sorted(odd.items())]
            spark.createDataFrame(noted, "path string, header string, reason string").coalesce(1).write.mode("overwrite").json(f"{quarantine}/batch_id={batch_id}")
        good = sorted(set(headers) - set(odd))
        if good:
            rows = spark.read.schema(schema).option("header", "true").option("enforceSchema", "false").csv(good)
            rows = rows.withColumn("case_name", F.col("_metadata.file_name")).withColumn("case_id", case_id(F.col("case_name")))
            safe = rows.toDF(*safe_names([VITALS_RENAMES.get(name, name) for name in rows.columns]))
            safe.write.mode("overwrite").partitionBy("case_id").parquet(f"{target}/batch_id={batch_id}")

    return names.writeStream.option("checkpointLocation", checkpoint).foreachBatch(land).trigger(availableNow=True).start()


def header_columns(line: str) -> list[str]:
    return next(csv.reader([line]), [])


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("path string, header string, reason string, batch_id long").json(path)
