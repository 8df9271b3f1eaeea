"""Streaming fraud scoring that corrects itself, with ``transformWithStateInPandas``.

Rows are cut into (customer, time bucket), as in the batch rules: a row near the
end of a bucket is copied into the next one as context, so a bucket has all the
history its rows look at, and a customer with very many rows is spread over as
many state keys as there are buckets. A state key is a (shard, time bucket): the
customers of a shard, told by a hash, share one, so that the calls for a
micro-batch are at most shards times the buckets it touches, however many customers
there are. ``shards`` is fixed for the life of a checkpoint. A key's rows are
held with the flags given so far, a list for each column; an event-time timer
clears them once the watermark has passed the bucket's end, when no row of it
can arrive any more.

A row that arrives after later ones changes what these should have seen. The
key's history flags are then worked out again, and each row whose flags
differ is emitted once more with ``revision`` one higher. ``latest_scores``
keeps the last revision of each row: what batch scoring gives for the rows that
arrived within the watermark. Rows without an event time have no history and
pass by the state.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from vigil import constants as K
from vigil.operators.rules import DEFAULT_RULES, RULE_COLUMNS, RuleConfig, _row_flags, _with_context_buckets, score

HISTORY_FLAGS = ["rule_impossible_travel", "rule_velocity", "rule_card_testing"]
ROW_FLAGS = [c for c in RULE_COLUMNS.values() if c not in HISTORY_FLAGS]

SHARDS = 256

_CARRIED = [StructField("customer_id", StringType()), StructField("transaction_id", StringType()), StructField("amount", DoubleType()), StructField("city", StringType()),
            StructField("ts_us", LongType()), StructField("context", BooleanType()), *[StructField(c, BooleanType()) for c in ROW_FLAGS]]
_GIVEN = [StructField("seq", LongType()), StructField("revision", IntegerType()), *[StructField(c, BooleanType()) for c in HISTORY_FLAGS]]
_ROW = _CARRIED + _GIVEN
STATE_SCHEMA = StructType([StructField(f.name, ArrayType(f.dataType)) for f in _ROW])
OUTPUT_SCHEMA = StructType([StructField("customer_id", StringType()), StructField("bucket", LongType()), *[f for f in _ROW if f.name not in ("customer_id", "context")]])
_DTYPES = {StringType: "object", DoubleType: "float64", LongType: "int64", IntegerType: "int64", BooleanType: "bool"}


def _before(values: np.ndarray, customer: np.ndarray, k: int, fill) -> np.ndarray:
    """The same customer's value k places earlier, ``fill`` where there is none."""
    out = np.full(len(values), fill, dtype=values.dtype)
    if k < len(values):
        same = customer[k:] == customer[: len(values) - k]
        out[k:][same] = values[: len(values) - k][same]
    return out


def history_flags(rows: dict[str, np.ndarray], customer: np.ndarray, cfg: RuleConfig) -> dict[str, np.ndarray]:
    """The history rules for rows in the order of (customer, event time, transaction id); ``customer`` numbers them."""
    ts, city, amount = rows["ts_us"].astype("float64"), rows["city"], rows["amount"]
    with np.errstate(invalid="ignore"):
        near = np.abs(ts - _before(ts, customer, 1, np.nan)) <= cfg.travel_max_minutes * 60e6
        return {
            "rule_impossible_travel": ((_before(city, customer, 1, None) == cfg.travel_from) & (city == cfg.travel_to) & near).astype(bool),
            "rule_velocity": _before(ts, customer, cfg.velocity_count, np.nan) >= ts - cfg.velocity_seconds * 1e6,
            "rule_card_testing": (amount >= cfg.card_test_min) & (amount <= cfg.card_test_max)
                                 & (_before(ts, customer, cfg.card_test_count, np.nan) >= ts - cfg.card_test_seconds * 1e6),
        }


class Corrector(StatefulProcessor):
    def __init__(self, cfg: RuleConfig) -> None:
        self.cfg = cfg

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("rows", STATE_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames, held = list(rows), self.held.get()
        n_held, n_new = len(held[0]) if held else 0, sum(map(len, frames))
        given = {"seq": np.arange(n_held, n_held + n_new), "revision": np.full(n_new, -1), **{c: np.zeros(n_new, bool) for c in HISTORY_FLAGS}}
        both = {}
        for i, f in enumerate(_ROW):
            new = [given[f.name]] if f.name in given else [frame[f.name].to_numpy() for frame in frames]
            both[f.name] = np.concatenate([np.array(held[i] if held else [], _DTYPES[type(f.dataType)]), *new]).astype(_DTYPES[type(f.dataType)])
        customer = pd.factorize(both["customer_id"], use_na_sentinel=False)[0]
        ids = both["transaction_id"]
        known = ~pd.isna(ids)
        order = np.lexsort((both["seq"], np.where(known, ids, "").astype(str), known, both["ts_us"], customer))
        both = {c: v[order] for c, v in both.items()}
        flags = history_flags(both, customer[order], self.cfg)
        other = np.any([flags[c] != both[c] for c in HISTORY_FLAGS], axis=0)
        out = (both["revision"] < 0) | (other & ~both["context"])
        both |= flags
        both["revision"] = both["revision"] + out
        self.held.update(tuple(_plain(both[f.name]) for f in _ROW))
        if not n_held:
            self.handle.registerTimer((int(key[1]) + 1) * self.cfg.bucket_seconds * 1000)
        out &= ~both["context"]
        if out.any():
            yield pd.DataFrame({c: key[1] if c == "bucket" else both[c][out] for c in OUTPUT_SCHEMA.names})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.held.clear()
        return iter([])


def _plain(values: np.ndarray) -> list:
    """Values as plain Python ones, None for what is missing."""
    if values.dtype.kind in "bi":
        return values.tolist()
    return np.where(pd.isna(values), None, values).tolist()


def corrected_scores(transactions: DataFrame, customers: DataFrame, merchants: DataFrame, cfg: RuleConfig = DEFAULT_RULES,
                     watermark: str = K.WATERMARK_DELAY, shards: int = SHARDS) -> DataFrame:
    """Scores of a transaction stream, with ``revision`` (0 for a row's first score) and what tells rows
    apart: (customer_id, bucket, seq). ``shards`` bounds the state keys of a time bucket."""
    # the processor travels by value: Spark also starts it on the driver, where shipped files aren't on the path
    for module in ("vigil.streaming.corrected", "vigil.operators.rules"):
        cloudpickle.register_pickle_by_value(sys.modules[module])
    t = (transactions.withWatermark("transaction_timestamp", watermark)
         .join(customers.select("customer_id", "trusted_device_id"), "customer_id", "left")
         .join(merchants.select("merchant_id", "merchant_risk", "is_blacklisted"), "merchant_id", "left"))
    t = t.select("transaction_id", "customer_id", "amount", "city", "transaction_timestamp", F.unix_micros("transaction_timestamp").alias("ts_us"),
                 *[c.alias(n) for n, c in _row_flags(cfg).items()])
    timed = _with_context_buckets(t.filter("transaction_timestamp IS NOT NULL"), "transaction_timestamp", cfg).withColumnsRenamed({"_bucket": "bucket", "_context": "context"})
    timed = timed.withColumn("shard", F.pmod(F.xxhash64("customer_id"), F.lit(shards)))
    scored = timed.groupBy("shard", "bucket").transformWithStateInPandas(
        Corrector(cfg), OUTPUT_SCHEMA, outputMode="append", timeMode="eventTime")
    untimed = t.filter("transaction_timestamp IS NULL").select(
        "customer_id", F.lit(None).cast("long").alias("bucket"), "transaction_id", "amount", "city", "ts_us", *ROW_FLAGS,
        F.xxhash64(F.uuid()).alias("seq"), F.lit(0).alias("revision"), *[F.lit(False).alias(c) for c in HISTORY_FLAGS])
    both = scored.unionByName(untimed)
    return score(both.withColumn("transaction_timestamp", F.timestamp_micros("ts_us")).drop("ts_us"))


def latest_scores(scores: DataFrame) -> DataFrame:
    """The last revision of each row (map-side first: a row has few revisions)."""
    key = ["customer_id", "bucket", "seq"]
    others = [c for c in scores.columns if c not in key]
    return scores.groupBy(*key).agg(F.max_by(F.struct(*others), "revision").alias("_row")).select(*key, "_row.*").select(*scores.columns)
