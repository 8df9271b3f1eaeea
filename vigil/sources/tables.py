"""Table sinks: namespaces, versioned snapshots, append tables.

No table format with transactions (Delta, Iceberg) is assumed. A full
snapshot is written to a new version folder and then published by adding a
small marker; readers take the newest marker, so they never see a
half-written snapshot and no folder is overwritten while it is read.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAMESPACES = {
    "bronze": "Raw ingested data",
    "silver": "Cleaned and validated data",
    "gold": "Alerts and aggregates",
    "source": "Landing zones for file sources",
}


def setup_namespaces(spark: SparkSession, base: str, comments: dict[str, str] = NAMESPACES) -> list[str]:
    """``CREATE DATABASE IF NOT EXISTS`` for each layer, located below ``base``."""
    created = []
    for name, comment in comments.items():
        location = f"{base.rstrip('/')}/{name}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} COMMENT '{comment}' LOCATION '{location}'")
        created.append(name)
    return created


def is_missing_path(e: AnalysisException) -> bool:
    """Whether a read failed because nothing is at the path yet."""
    return e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _markers(path: str) -> str:
    return f"{path.rstrip('/')}/_published"


def write_snapshot(df: DataFrame, path: str, version: str | None = None, replace_version: bool = False) -> str:
    """Write ``df`` as a new version of the snapshot at ``path`` and publish it.

    Nothing is ever overwritten that a reader may be reading: the data goes to
    a new version folder, then a small publish marker is added (a separate
    write job, visible only once committed). Readers take the newest marker.
    ``replace_version`` lets a retried writer rewrite its own version folder
    (same name) before it is published.
    """
    spark = df.sparkSession
    stamp = f"{time.time_ns():020d}"
    version = version or f"v{stamp}"
    folder = f"{path.rstrip('/')}/{version}"
    df.write.mode("overwrite" if replace_version else "errorifexists").parquet(folder)
    (spark.createDataFrame([(stamp, folder)], "published string, folder string")
     .coalesce(1).write.mode("append").json(_markers(path)))
    return folder


def current_snapshot_path(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest published version, or None when nothing is published."""
    try:
        markers = spark.read.schema("published string, folder string").json(_markers(path))
    except AnalysisException as e:
        if not is_missing_path(e):
            raise                       # a storage error must not look like an empty table
        return None
    # markers are one line each; the newest is found by an aggregate, not by reading them all to the driver
    row = markers.filter(F.col("folder").isNotNull()).agg(F.max(F.struct("published", "folder")).alias("m")).first()
    return row.m.folder if row.m else None


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    current = current_snapshot_path(spark, path)
    if current is None:
        raise FileNotFoundError(f"no snapshot at {path}")
    return spark.read.parquet(current)
