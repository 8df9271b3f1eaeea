"""Streaming fraud scoring with state of each customer's history (history rules).

Stateless rules are plain column expressions evaluated before the state
operator. The history rules (previous transaction, k earlier ones within s
seconds) need the customer's earlier transactions; they are kept in state as
arrays (customer, event time in microseconds, transaction id, city), all of them that can
still matter: none is older than the watermark less the rules' horizon. The customers of
a shard, told by a hash, share a state key, so that a micro-batch calls the Python
function at most ``SHARDS`` times, however many customers there are; the number is
fixed for the life of a checkpoint. An event-time timeout removes a shard's state once the
watermark is more than the horizon past its last transaction.

The new rows of a shard are merged with the history in the order of (customer, event
time, transaction id), so a row that arrives late but within the watermark looks
only at earlier rows; the lags are array shifts (numpy, one pass per group; no
per-row Python loop). A row beyond the watermark gets no score: Spark drops it and counts
it (``flows.late_rows_dropped``). A row scored earlier isn't scored again when an earlier
one arrives after it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from vigil import constants as K
from vigil.operators.rules import DEFAULT_RULES, RuleConfig, score
from vigil.sources.tables import is_missing_path

SHARDS = 1024

STATE_SCHEMA = StructType([
    StructField("customer_id", ArrayType(StringType())),
    StructField("ts_us", ArrayType(LongType())),
    StructField("id", ArrayType(StringType())),
    StructField("city", ArrayType(StringType())),
])

_PASS = ["transaction_id", "customer_id", "amount", "city", "_ts_us",
         "rule_high_value", "rule_new_device", "rule_high_risk_merchant",
         "rule_blacklisted_merchant", "rule_international"]

OUTPUT_SCHEMA = StructType([
    StructField("transaction_id", StringType()),
    StructField("customer_id", StringType()),
    StructField("amount", DoubleType()),
    StructField("city", StringType()),
    StructField("_ts_us", LongType()),
    *[StructField(c, BooleanType()) for c in _PASS[5:]],
    StructField("rule_impossible_travel", BooleanType()),
    StructField("rule_velocity", BooleanType()),
    StructField("rule_card_testing", BooleanType()),
])


def _lag(values: np.ndarray, customer: np.ndarray, k: int, at: np.ndarray, fill) -> np.ndarray:
    """values[i - k] for the positions ``at``, ``fill`` before the customer's start."""
    idx = at - k
    out = np.full(len(idx), fill, dtype=values.dtype if fill is not None else object)
    ok = idx >= 0
    ok[ok] = customer[idx[ok]] == customer[at[ok]]
    out[ok] = values[idx[ok]]
    return out


def history_processor(cfg: RuleConfig, watermark_seconds: int):
    horizon_ms = cfg.horizon_seconds * 1000
    delay_us = watermark_seconds * 1_000_000
    vel_us, card_us = cfg.velocity_seconds * 1_000_000, cfg.card_test_seconds * 1_000_000
    travel_us = cfg.travel_max_minutes * 60_000_000.0

    def process(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        frames = list(pdfs)
        new = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        if new.empty:
            return
        new_ts = new["_ts_us"].to_numpy(dtype="float64", na_value=np.nan)
        hist_customer, hist_ts, hist_id, hist_city = (list(x or []) for x in state.get) if state.exists else ([], [], [], [])
        n_hist = len(hist_ts)
        ts = np.concatenate([np.asarray(hist_ts, dtype="float64"), new_ts])
        ids = np.concatenate([np.asarray(hist_id, dtype=object), new["transaction_id"].to_numpy(dtype=object)])
        city = np.concatenate([np.asarray(hist_city, dtype=object), new["city"].to_numpy(dtype=object)])
        who = np.concatenate([np.asarray(hist_customer, dtype=object), new["customer_id"].to_numpy(dtype=object)])
        customer = pd.factorize(who, use_na_sentinel=False)[0]
        # event order of history and batch: (customer, time, id); missing times first
        order = np.lexsort((ids.astype(str), np.nan_to_num(ts, nan=-np.inf), customer))
        ts, ids, city, who, customer = ts[order], ids[order], city[order], who[order], customer[order]
        at = np.flatnonzero(order >= n_hist)             # where the new rows stand
        new = new.iloc[order[at] - n_hist]
        new_ts, new_city = ts[at], city[at]
        prev_ts = _lag(ts, customer, 1, at, np.nan)
        prev_city = _lag(city, customer, 1, at, None)
        vel_ts = _lag(ts, customer, cfg.velocity_count, at, np.nan)
        card_ts = _lag(ts, customer, cfg.card_test_count, at, np.nan)
        amount = new["amount"].to_numpy(dtype="float64", na_value=np.nan)
        with np.errstate(invalid="ignore"):
            travel = ((prev_city == cfg.travel_from) & (new_city == cfg.travel_to)
                      & (np.abs(new_ts - prev_ts) <= travel_us))
            velocity = vel_ts >= new_ts - vel_us
            card = (amount >= cfg.card_test_min) & (amount <= cfg.card_test_max) & (card_ts >= new_ts - card_us)
        out = {c: new[c].to_numpy() for c in _PASS}
        out["_ts_us"] = pd.array(new_ts, dtype="Int64")          # a missing event time stays null
        out["rule_impossible_travel"] = travel.astype(bool)
        out["rule_velocity"] = velocity.astype(bool)
        out["rule_card_testing"] = card.astype(bool)
        # keep the entries that a transaction still to come can look at: it won't be older than the watermark
        timed = ts[~np.isnan(ts)]
        if len(timed):
            watermark_us = max(state.getCurrentWatermarkMs() * 1000, int(timed.max()) - delay_us)
            valid = ts >= watermark_us - horizon_ms * 1000
            state.update(([None if x is None else str(x) for x in who[valid]], ts[valid].astype("int64").tolist(), [None if x is None else str(x) for x in ids[valid]],
                          [None if c is None else str(c) for c in city[valid]]))
            expire_ms = int(timed.max() // 1000) + horizon_ms
            state.setTimeoutTimestamp(max(expire_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out)

    return process


def _seconds(delay: str) -> int:
    """Seconds of a delay such as ``5 minutes``."""
    n, unit = delay.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def stream_scores(transactions: DataFrame, customers: DataFrame, merchants: DataFrame,
                  cfg: RuleConfig = DEFAULT_RULES, watermark: str = K.WATERMARK_DELAY) -> DataFrame:
    """Streaming form of ``score_transactions``: same flags, score and reasons.

    ``transactions`` is a stream with a ``timestamp`` event time; customers and
    merchants are static lookups. Rows of one customer are evaluated in event order.
    """
    from vigil.session import ship_package
    ship_package(transactions.sparkSession)      # the group function runs in Python workers
    cust = customers.select("customer_id", "trusted_device_id")
    merch = merchants.select("merchant_id", "merchant_risk", "is_blacklisted")
    t = (transactions.withWatermark("transaction_timestamp", watermark)
         .join(cust, "customer_id", "left").join(merch, "merchant_id", "left"))
    t = t.select(
        "transaction_id", "customer_id", "amount", "city", "transaction_timestamp",
        F.unix_micros("transaction_timestamp").alias("_ts_us"),
        F.coalesce(F.col("amount") > F.lit(cfg.high_value_amount), F.lit(False)).alias("rule_high_value"),
        (~F.col("device_id").eqNullSafe(F.col("trusted_device_id"))).alias("rule_new_device"),
        F.col("merchant_risk").eqNullSafe(F.lit(cfg.high_risk_level)).alias("rule_high_risk_merchant"),
        F.coalesce(F.col("is_blacklisted"), F.lit(False)).alias("rule_blacklisted_merchant"),
        F.coalesce(F.col("is_international"), F.lit(False)).alias("rule_international"),
    )
    flagged = t.withColumn("shard", F.pmod(F.xxhash64("customer_id"), F.lit(SHARDS))).groupBy("shard").applyInPandasWithState(
        history_processor(cfg, _seconds(watermark)), OUTPUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)
    return score(flagged.withColumn("transaction_timestamp", F.timestamp_micros("_ts_us")).drop("_ts_us"))


# --------------------------------------------------------------------------
# Tail-based scoring: the same plan as batch scoring, per micro-batch.
#
# Each micro-batch is scored together with a "tail": the transactions of the
# last ``horizon`` seconds, and the watermark's delay, before each customer's
# newest event so far (older rows can no longer change a history rule for rows
# that arrive within the delay; a row that comes later is scored against the
# history kept so far). The batch scorer's
# time-bucketed windows run on batch + tail, so a hot customer is spread over
# tasks within a micro-batch too, and no Python runs per group. The tail is a
# Parquet folder per batch id, published by a marker; a retried batch reads
# the tail published before it and overwrites its own outputs (idempotent).
# --------------------------------------------------------------------------

_TAIL_MARKER_SCHEMA = "batch_id long, folder string"


def _tail_before(spark, tail_path: str, batch_id: int) -> DataFrame | None:
    try:
        markers = spark.read.schema(_TAIL_MARKER_SCHEMA).json(f"{tail_path}/_published")
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
        return None
    row = markers.filter(F.col("batch_id") < batch_id).agg(F.max(F.struct("batch_id", "folder")).alias("m")).first()
    return spark.read.parquet(row.m.folder) if row.m else None


def tail_scoring_writer(out_path: str, tail_path: str, customers: DataFrame | Callable[[], DataFrame], merchants: DataFrame,
                        cfg: RuleConfig = DEFAULT_RULES, columns: list[str] | None = None,
                        query_id: Callable[[], str] | None = None, watermark: str = K.WATERMARK_DELAY):
    """A ``foreachBatch`` function: score the batch with the previous tail as
    history, write ``out_path/batch_id=n`` (below ``query=<id>`` where the
    query's id is given), publish the new tail. ``customers`` may be a function, called for each batch."""
    from vigil.functions.columns import interval_seconds
    from vigil.operators.rules import score_transactions

    def run(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        cols = columns or [c for c in batch_df.columns if c not in ("event_date",)]
        batch = batch_df.select(*cols).persist()
        try:
            own = f"/query={query_id()}" if query_id else ""
            history = _tail_before(spark, tail_path + own, batch_id)
            lookup = customers() if callable(customers) else customers
            scored = score_transactions(batch, lookup, merchants, cfg, history=history)
            scored.write.mode("overwrite").parquet(f"{out_path}{own}/batch_id={batch_id}")
            rows = batch if history is None else batch.unionByName(history.select(*cols))
            # by customer, so one event dated in the future doesn't empty the others' tails
            newest = rows.groupBy(F.col("customer_id").alias("_customer")).agg(F.max("transaction_timestamp").alias("_newest"))
            keep_from = F.col("_newest") - interval_seconds(cfg.horizon_seconds + _seconds(watermark))
            tail = (rows.join(newest, F.col("customer_id").eqNullSafe(F.col("_customer")))
                    .filter(F.col("transaction_timestamp") >= keep_from).select(*cols))
            folder = f"{tail_path}{own}/batch_{batch_id:012d}"
            tail.write.mode("overwrite").parquet(folder)
            (spark.createDataFrame([(batch_id, folder)], _TAIL_MARKER_SCHEMA).coalesce(1)
             .write.mode("append").json(f"{tail_path}{own}/_published"))
        finally:
            batch.unpersist()

    return run
