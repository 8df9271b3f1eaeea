"""Intermediate tables in the folder that the cluster shares, and what tasks in Python workers have in common."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; on one machine a new folder where it is unset."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="vigil-llm-")
        sc.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/vigil-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back; ``options`` go to the writer.

    Cuts the lineage: a lost executor costs at most the tasks since this table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_by_value() -> None:
    """Let Python workers get this package's functions inside the pickled task.

    The workers then need neither the repository on their path nor a shipped
    archive.
    """
    cloudpickle.register_pickle_by_value(sys.modules["vigil.llm"])


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, for mapInArrow; at a task's end its worker gives memory that is free back to the system.

    Spark keeps workers for later tasks. Without this, each keeps the most that any
    of its tasks took, beside whatever the executor does by then.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)

    return task


def broadcast_if_small(df: DataFrame, most_rows: int = 1_000_000) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most_rows`` rows of a few numbers; else as it is.

    ``df`` should be a stored table: it is counted. Beyond the bound Spark
    shuffles both sides of the join.
    """
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df
