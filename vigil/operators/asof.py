"""Point-in-time lookup: each event with the version of its key that held at the event's time.

Events and versions of a key are put in one table and ordered by time; a running
last value carries the version to the events after it: a sort, no range
comparison of rows. Keys are split into time buckets, so a key with very many events
is many groups. What holds at a bucket's beginning, the last version before it, is
carried into it as one row; that is found on one row for each bucket of a
key, not on the events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.columns import is_ntz


def as_of(events: DataFrame, versions: DataFrame, *, key: str, event_time: str, version_time: str, bucket_seconds: int = 86_400) -> DataFrame:
    """``events`` with ``version``: a struct of the columns of ``versions`` (a row for each change) that held at the event.

    A version holds from its time on, the time itself included, until the next one of its key; of two with one time
    the one with the greater columns, compared from left to right. An event before all versions of its key, with an
    unknown key, or without a time or key, has a null version. Versions without a time or key never hold.
    """
    # the version's columns in a struct, so that no name clashes
    values = F.struct(*[F.col(f"`{c}`") for c in versions.columns])
    zoneless = is_ntz(events, event_time)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz" if zoneless else "timestamp")

    def micros(column):
        return F.timestamp_diff("MICROSECOND", epoch, column.cast("timestamp_ntz" if zoneless else "timestamp"))

    def bucket(at):
        return F.floor(at / F.lit(bucket_seconds * 1_000_000)).cast("long")

    e = events.select(F.col(f"`{key}`").alias("key"), micros(F.col(f"`{event_time}`")).alias("at"), F.struct(*[F.col(f"`{c}`") for c in events.columns]).alias("event"))
    v = versions.select(F.col(f"`{key}`").alias("key"), micros(F.col(f"`{version_time}`")).alias("at"), values.alias("version")).filter("key IS NOT NULL AND at IS NOT NULL")
    v = v.groupBy("key", "at").agg(F.max("version").alias("version")).withColumn("bucket", bucket(F.col("at")))
    timed = e.filter("key IS NOT NULL AND at IS NOT NULL").withColumn("bucket", bucket(F.col("at")))

    # one row for each bucket of a key that has events or versions; the last version before it
    ends = v.groupBy("key", "bucket").agg(F.max_by("version", "at").alias("last"))
    asked = timed.select("key", "bucket").distinct().withColumn("asked", F.lit(True))
    chain = ends.join(asked, ["key", "bucket"], "full")
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = chain.withColumn("version", F.last("last", ignorenulls=True).over(before)).filter("asked AND version IS NOT NULL")
    none = F.lit(None).cast(events.select(F.struct("*")).schema[0].dataType)
    carried = carried.select("key", "bucket", F.lit(None).cast("long").alias("at"), F.lit(0).alias("kind"), none.alias("event"), "version")

    changes = v.select("key", "bucket", "at", F.lit(0).alias("kind"), none.alias("event"), "version")
    rows = timed.select("key", "bucket", "at", F.lit(1).alias("kind"), "event", F.lit(None).cast(v.schema["version"].dataType).alias("version"))
    # dealt by key and bucket, or a partitioning by key alone might be used again
    both = rows.unionByName(changes).unionByName(carried).repartition("key", "bucket")
    order = Window.partitionBy("key", "bucket").orderBy(F.col("at").asc_nulls_first(), "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = both.withColumn("held", F.last("version", ignorenulls=True).over(order)).filter("kind = 1")
    rest = e.filter("key IS NULL OR at IS NULL").select("event", F.lit(None).cast(v.schema["version"].dataType).alias("held"))
    return held.select("event", "held").unionByName(rest).select("event.*", F.col("held").alias("version"))
