"""Compaction of a streaming table's small files.

Files below the target size are packed into bins of about that size, each bin is written as
one file into a new folder, and a numbered manifest is published that names the
folder and the files it stands for. The table's own files and its commit log stay as they are, so
streams that read the table go on undisturbed; ``read_compacted`` reads the packed files in place of those
they stand for, and the files that came since. A manifest's number is taken once: of two compactions at
a time the second fails. ``expired_files`` lists what compaction has replaced long enough ago.
"""

from __future__ import annotations

import re
import uuid
from datetime import datetime
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.sources.tables import is_missing_path

_MANIFEST = "number long, folder string, file string, written timestamp"


def _manifests(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{path}_compacted/manifests/*")
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
        return spark.createDataFrame([], _MANIFEST)


def file_sizes(df: DataFrame) -> DataFrame:
    """(file, size) of the files that a frame is read from."""
    return df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).distinct()


def bins(sizes: DataFrame, target_bytes: int) -> DataFrame:
    """(file, bin): files in the order of their size, cut where their sum passes a multiple of the target."""
    upto = Window.orderBy(F.desc("size"), "file").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("file", F.floor(F.coalesce(F.sum("size").over(upto), F.lit(0)) / target_bytes).cast("int").alias("bin"))   # a row for each file


def compact(spark: SparkSession, path: str, target_bytes: int = 128 << 20) -> int:
    """Pack the files below the target that no manifest stands for yet; returns how many were packed."""
    manifests = _manifests(spark, path)
    table = spark.read.parquet(path)
    small = file_sizes(table).join(manifests.select("file"), "file", "left_anti").filter(F.col("size") < target_bytes)
    packed = bins(small, target_bytes).persist()
    try:
        files, last = packed.agg(F.count("*"), F.max("bin")).first()
        if files < 2:
            return 0
        folder = f"{path}_compacted/data/{uuid.uuid4().hex}"
        rows = table.withColumn("_file", F.col("_metadata.file_path")).join(packed.withColumnRenamed("file", "_file"), "_file")
        # a range for each bin, so that no two bins share a file
        rows.repartitionByRange(last + 1, "bin").drop("_file", "bin").write.parquet(folder)
        number = (manifests.agg(F.max("number")).first()[0] or 0) + 1
        packed.select(F.lit(number).cast("long").alias("number"), F.lit(folder).alias("folder"), "file", F.current_timestamp().alias("written")) \
            .coalesce(1).write.parquet(f"{path}_compacted/manifests/{number:08d}")
        return files
    finally:
        packed.unpersist()


def read_compacted(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows: packed files, and the committed files that no manifest stands for."""
    manifests = _manifests(spark, path).persist()
    try:
        table = spark.read.parquet(path)
        folders = [r.folder for r in manifests.select("folder").distinct().collect()]      # one for each compaction
        # file names, as Spark itself holds them on the driver for a table; local ones with one slash, as in _metadata
        names = spark.createDataFrame([(re.sub("^file:/+", "file:/", f),) for f in table.inputFiles()], "file string")
        rest = [unquote(r.file) for r in names.join(manifests, "file", "left_anti").collect()]
    finally:
        manifests.unpersist()
    parts = ([spark.read.schema(table.schema).parquet(*folders)] if folders else []) + ([spark.read.schema(table.schema).option("basePath", path).parquet(*rest)] if rest else [])
    if not parts:
        return table
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def expired_files(spark: SparkSession, path: str, before: datetime) -> DataFrame:
    """(file, written) of the table's files that were packed before a time: no batch reader needs them any more; a stream
    that hasn't read them yet does."""
    return _manifests(spark, path).filter(F.col("written") < F.lit(before)).select("file", "written")
