"""A snapshot in hash buckets, merged bucket by bucket.

The rows of a key always stand in the bucket given by the key's hash. A manifest
says for each bucket which folder holds it. ``merge`` rewrites the buckets that
the changes touch, into a new folder each, and publishes a manifest that names
these and, for all others, the folders they had: a small change costs a small
rewrite, and readers of an older manifest lose nothing.

Manifests are numbered; number n + 1 can be written once only, so of two writers
that started from the same manifest the second fails instead of undoing the
first. ``label`` makes a merge idempotent: one that a manifest already carries is
not repeated (a micro-batch retried after a restart).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.silver import latest_per_key
from vigil.sources.tables import is_missing_path

BUCKET = "_bucket"
MANIFEST = "number long, buckets int, bucket int, folder string, label string"


@dataclass(frozen=True)
class Manifest:
    number: int
    buckets: int
    folders: dict[int, str]       # at most one entry for each bucket


class BucketedSnapshot:
    def __init__(self, spark: SparkSession, path: str, key: str, order_by: str) -> None:
        self.spark, self.path, self.key, self.order_by = spark, path.rstrip("/"), key, order_by

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(buckets)).cast("int")

    def _manifests(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(MANIFEST).json(f"{self.path}/_manifests/*")
        except AnalysisException as e:
            if not is_missing_path(e):
                raise
            return None

    def manifest(self) -> Manifest | None:
        """The newest manifest (a row for each bucket); None before ``create``."""
        rows = self._manifests()
        last = rows.agg(F.max("number")).first()[0] if rows is not None else None
        if last is None:
            return None
        found = rows.filter(F.col("number") == last).collect()
        return Manifest(last, found[0].buckets, {r.bucket: r.folder for r in found if r.folder})

    def _publish(self, number: int, buckets: int, folders: dict[int, str], label: str | None) -> None:
        rows = [(number, buckets, b, folders.get(b), label) for b in range(buckets)]
        # mode "error": a number is taken once
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.json(f"{self.path}/_manifests/{number:012d}")

    def _write(self, rows: DataFrame, touched: list[int]) -> dict[int, str]:
        """Rows dealt by bucket into a new folder; where each touched bucket is now."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        rows.write.partitionBy(BUCKET).parquet(folder)
        there = {r[0] for r in self.spark.read.parquet(folder).select(BUCKET).distinct().collect()} if touched else set()
        return {b: f"{folder}/{BUCKET}={b}" for b in touched if b in there}

    def create(self, df: DataFrame, buckets: int, label: str | None = None) -> None:
        """The first manifest, over the latest row of each key."""
        rows = latest_per_key(df, self.key, self.order_by).withColumn(BUCKET, self._bucket(buckets))
        self._publish(0, buckets, self._write(rows.repartition(buckets, BUCKET), list(range(buckets))), label)

    def read(self, manifest: Manifest | None = None) -> DataFrame:
        """The snapshot under the newest manifest, or the given one."""
        manifest = manifest or self.manifest()
        if manifest is None:
            raise FileNotFoundError(f"no snapshot at {self.path}")
        return self.spark.read.parquet(*manifest.folders.values())

    def merge(self, changes: DataFrame, label: str | None = None) -> list[int]:
        """The latest row of each key of snapshot and ``changes`` (on equal times the change); returns the buckets rewritten."""
        manifest = self.manifest()
        if manifest is None:
            raise FileNotFoundError(f"no snapshot at {self.path}")
        if label is not None and not self._manifests().filter(F.col("label") == label).isEmpty():
            return []
        bucket = self._bucket(manifest.buckets)
        newest = latest_per_key(changes, self.key, self.order_by).withColumn(BUCKET, bucket).persist()
        try:
            touched = sorted(r[0] for r in newest.select(BUCKET).distinct().collect())   # at most the number of buckets
            held = [manifest.folders[b] for b in touched if b in manifest.folders]
            others = [c for c in changes.columns if c != self.key]
            both = newest.withColumn("_change", F.lit(True))
            if held:
                old = self.spark.read.parquet(*held).select(*changes.columns).withColumn(BUCKET, bucket)
                both = both.unionByName(old.withColumn("_change", F.lit(False)))
            # one shuffle, by bucket: it serves the merge and leaves a file for each bucket
            both = both.repartition(max(1, len(touched)), BUCKET)
            merged = both.groupBy(BUCKET, self.key).agg(
                F.max_by(F.struct(*others), F.struct(F.col(self.order_by), F.col("_change"))).alias("_row")).select(self.key, "_row.*", BUCKET)
            folders = {b: f for b, f in manifest.folders.items() if b not in touched}
            self._publish(manifest.number + 1, manifest.buckets, folders | self._write(merged.select(*changes.columns, BUCKET), touched), label)
        finally:
            newest.unpersist()
        return touched
