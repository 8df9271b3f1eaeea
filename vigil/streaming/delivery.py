"""Delivery of outbox rows: a ledger of attempts, and what is due by it.

Attempts are appended, never changed: one row for each notification that a run
tried, sent or failed with the reason. What is due is what can be delivered, was
not sent, has tries left, and whose last failure is long enough ago: the pause
doubles with each try. A run writes its attempts below ``run=<name>`` in one go; a
run that is repeated under its name leaves its own earlier attempts out of account, tries the same
notifications and replaces them, so nothing counts twice. The sender gets the
notification's id, so that a channel can tell a repetition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.sources.tables import is_missing_path

LEDGER = "alert_type string, alert_id string, attempt int, attempted_at timestamp, sent boolean, error string, run string"
KEY = ["alert_type", "alert_id"]


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).option("basePath", path).parquet(path)
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
        return spark.createDataFrame([], LEDGER)


def attempts(ledger: DataFrame) -> DataFrame:
    """One row for each notification tried: tries, whether it was sent, the last try and its error (map-side first)."""
    return ledger.groupBy(*KEY).agg(F.count("*").cast("int").alias("attempts"), F.bool_or("sent").alias("sent"), F.max("attempted_at").alias("last_attempt"),
                                    F.max_by("error", "attempt").alias("last_error"))


def due(outbox: DataFrame, ledger: DataFrame, now: datetime, *, pause_seconds: int = 60, most_attempts: int = 8) -> DataFrame:
    """The outbox rows to try at ``now``, with the number of this attempt; each notification once, however often it stands in the outbox."""
    rest = [c for c in outbox.columns if c not in KEY]
    pending = outbox.filter("delivery_status = 'PENDING'").groupBy(*KEY).agg(F.min(F.struct(*rest)).alias("_row")).select(*KEY, "_row.*")
    tried = attempts(ledger)
    rows = pending.join(tried, KEY, "left").withColumn("attempts", F.coalesce("attempts", F.lit(0)))
    pause = F.make_dt_interval(secs=(F.lit(pause_seconds) * F.pow(F.lit(2.0), F.col("attempts") - 1)).cast("decimal(18,6)"))
    waited = F.col("last_attempt").isNull() | (F.col("last_attempt") + pause <= F.lit(now))
    rows = rows.filter(~F.coalesce("sent", F.lit(False)) & (F.col("attempts") < most_attempts) & waited)
    return rows.select(*outbox.columns, (F.col("attempts") + 1).alias("attempt"))


def deliver(outbox: DataFrame, ledger_path: str, run: str, send: Callable[[dict], None], now: datetime, **limits) -> DataFrame:
    """Try what is due; the attempts as written. ``send`` gets a row as a dictionary, on the executors, and raises what it fails with."""
    spark = outbox.sparkSession
    before = read_ledger(spark, ledger_path).filter(F.col("run") != run)
    rows = due(outbox, before, now, **limits)

    def tried(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            errors = []
            for row in frame.to_dict("records"):
                try:
                    send(row)
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - one that fails doesn't stop the others; it is tried again later
                    errors.append(f"{type(e).__name__}: {e}")
            yield frame[[*KEY, "attempt"]].assign(error=pd.Series(errors, dtype=object, index=frame.index))

    made = rows.mapInPandas(tried, "alert_type string, alert_id string, attempt int, error string")
    made = made.select(*KEY, "attempt", F.lit(now).cast("timestamp").alias("attempted_at"), F.col("error").isNull().alias("sent"), "error")
    made.write.mode("overwrite").parquet(f"{ledger_path}/run={run}")
    return spark.read.schema(LEDGER).option("basePath", ledger_path).parquet(f"{ledger_path}/run={run}")


def delivery_report(outbox: DataFrame, ledger: DataFrame) -> DataFrame:
    """Each notification of the outbox: its state (SENT, WAITING, INVALID), tries and last error."""
    known = outbox.groupBy(*KEY).agg(F.bool_or(F.col("delivery_status") == "PENDING").alias("_can"))
    rows = known.join(attempts(ledger), KEY, "left")
    state = F.when(F.coalesce("sent", F.lit(False)), "SENT").when(F.col("_can"), "WAITING").otherwise("INVALID")
    return rows.select(*KEY, state.alias("state"), F.coalesce("attempts", F.lit(0)).alias("attempts"), "last_error")
