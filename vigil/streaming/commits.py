"""One micro-batch into several tables, seen together or not at all.

``write_batch`` writes a frame for each table below ``query=<id>/batch_id=<n>``
(overwrite: a retried batch replaces what an ended attempt left) and then one marker. Readers
(``read_committed``) see only batches with a marker, in every table alike, so a
driver that dies between two writes loses and doubles nothing: the query
repeats the batch, which is either complete already or written again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.sources.tables import is_missing_path

_MARKER = "query string, batch_id long, tables array<string>"


def _markers(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_MARKER).json(f"{path}/_committed")
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
        return spark.createDataFrame([], _MARKER)


def write_batch(path: str, query: str, batch_id: int, tables: dict[str, DataFrame]) -> bool:
    """Write and commit the batch's tables; False if it had been committed before."""
    spark = next(iter(tables.values())).sparkSession
    done = _markers(spark, path).filter((F.col("query") == query) & (F.col("batch_id") == batch_id))
    if not done.isEmpty():
        return False
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}/query={query}/batch_id={batch_id}")
    spark.createDataFrame([(query, batch_id, list(tables))], _MARKER).coalesce(1).write.mode("append").json(f"{path}/_committed")
    return True


def read_committed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The committed batches of a table. The partitions are pruned by the markers while the query runs."""
    rows = spark.read.option("basePath", f"{path}/{name}").parquet(f"{path}/{name}")
    committed = _markers(spark, path).filter(F.array_contains("tables", name)).select("query", "batch_id").distinct()
    rows = rows.withColumns({"query": F.col("query").cast("string"), "batch_id": F.col("batch_id").cast("long")})
    return rows.join(committed, ["query", "batch_id"], "left_semi").drop("query", "batch_id")
