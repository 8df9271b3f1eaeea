"""Transaction counts per event-time window (tumbling or sliding).

Streaming frames run under a watermark in append mode (a window is emitted
once the watermark passes its end); sliding windows are chained over
slide-sized bucket counts there too.

Batch frames with a sliding window whose length is a multiple of the slide
are counted in two levels: first per slide-sized bucket (one hash probe per
row, partial aggregation before the shuffle), then each bucket count is added
to the ``length / slide`` windows that contain the bucket. The ×N expansion is
applied to bucket counts instead of to every row. Rows with a null event time
belong to no window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil import constants as K
from vigil.functions.columns import interval_seconds


def _seconds(duration: str) -> int:
    n, unit = duration.strip().split(None, 1)
    unit = unit.lower().rstrip("s")
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}[unit]
    return int(n) * scale


def _direct(df: DataFrame, ts: str, window_duration: str, slide_duration: str | None) -> DataFrame:
    w = F.window(ts, window_duration, slide_duration) if slide_duration else F.window(ts, window_duration)
    return (df.groupBy(w.alias("window"))
            .agg(F.count(F.lit(1)).alias("transaction_count"))
            .select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"),
                    "transaction_count"))


def _bucketed(df: DataFrame, ts: str, window_duration: str, slide_duration: str) -> DataFrame:
    win_s, slide_s = _seconds(window_duration), _seconds(slide_duration)
    n = win_s // slide_s
    buckets = (df.groupBy(F.window(ts, slide_duration).start.alias("bucket"))
               .agg(F.count(F.lit(1)).alias("n")))
    offsets = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("k")
    starts = buckets.select("bucket", "n", offsets).select(
        (F.col("bucket") - interval_seconds(F.col("k") * slide_s)).alias("window_start"), "n")
    return (starts.groupBy("window_start")
            .agg(F.sum("n").alias("transaction_count"))
            .select("window_start",
                    (F.col("window_start") + interval_seconds(F.lit(win_s))).alias("window_end"),
                    "transaction_count"))


def _bucketed_stream(df: DataFrame, ts: str, window_duration: str, slide_duration: str) -> DataFrame:
    """Streaming two-level form: a stateful count per slide bucket, then the
    sliding windows over the bucket counts (chained time-window aggregations;
    ``window_time`` of a bucket is its last instant, which lies in exactly the
    windows that contain the bucket)."""
    buckets = (df.groupBy(F.window(ts, slide_duration).alias("bucket"))
               .agg(F.count(F.lit(1)).alias("n")))
    return (buckets.groupBy(F.window(F.window_time("bucket"), window_duration, slide_duration).alias("window"))
            .agg(F.sum("n").alias("transaction_count"))
            .select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"),
                    "transaction_count"))


def transaction_counts(transactions: DataFrame, window_duration: str, slide_duration: str | None = None,
                       ts: str = "transaction_timestamp", watermark: str = K.WATERMARK_DELAY) -> DataFrame:
    """window_start, window_end, transaction_count per event-time window."""
    two_level = (slide_duration is not None and _seconds(window_duration) % _seconds(slide_duration) == 0
                 and _seconds(window_duration) != _seconds(slide_duration))
    if transactions.isStreaming:
        wm = transactions.withWatermark(ts, watermark)
        if two_level:
            return _bucketed_stream(wm, ts, window_duration, slide_duration)
        return _direct(wm, ts, window_duration, slide_duration)
    if two_level:
        return _bucketed(transactions, ts, window_duration, slide_duration)
    return _direct(transactions, ts, window_duration, slide_duration)


def tumbling_counts(transactions: DataFrame, **kw) -> DataFrame:
    return transaction_counts(transactions, K.TUMBLING_WINDOW, None, **kw)


def sliding_counts(transactions: DataFrame, **kw) -> DataFrame:
    return transaction_counts(transactions, K.SLIDING_WINDOW, K.SLIDING_SLIDE, **kw)
