"""Rule-based fraud scoring as one Spark job.

Eight rules, each with a weight; the score is the capped sum of the weights of
the rules that hold, the reason is the first rule that holds (evaluation
order), the dominant reason the one with the greatest weight (the earlier rule
on equal weight). History rules look at the customer's earlier transactions in
event-time order (ties broken by transaction id):

  previous transaction          lag(city, 1), lag(ts, 1)
  k earlier ones within s secs  lag(ts, k) >= ts - s

Skew: all history rules look back at most ``horizon`` seconds. Rows are
partitioned by (customer, time bucket) instead of by customer alone, and each
row within ``horizon`` of the next bucket is copied into that bucket as
context. Every row then sees all of its predecessors within the horizon, so
the lags are exact, while a hot customer is spread over many tasks (one per
bucket) instead of one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil import constants as K
from vigil.functions.columns import interval_seconds, is_ntz, minutes_between

RULE_COLUMNS = {
    "HIGH_VALUE_TRANSACTION": "rule_high_value",
    "IMPOSSIBLE_TRAVEL": "rule_impossible_travel",
    "NEW_DEVICE": "rule_new_device",
    "HIGH_RISK_MERCHANT": "rule_high_risk_merchant",
    "BLACKLISTED_MERCHANT": "rule_blacklisted_merchant",
    "INTERNATIONAL_TRANSACTION": "rule_international",
    "VELOCITY_FRAUD": "rule_velocity",
    "CARD_TESTING": "rule_card_testing",
}


@dataclass(frozen=True)
class RuleConfig:
    high_value_amount: float = K.HIGH_VALUE_AMOUNT
    travel_from: str = K.TRAVEL_FROM_CITY
    travel_to: str = K.TRAVEL_TO_CITY
    travel_max_minutes: float = K.TRAVEL_MAX_MINUTES
    velocity_count: int = K.VELOCITY_COUNT
    velocity_seconds: int = K.VELOCITY_SECONDS
    card_test_count: int = K.CARD_TEST_COUNT
    card_test_seconds: int = K.CARD_TEST_SECONDS
    card_test_min: float = K.CARD_TEST_MIN_AMOUNT
    card_test_max: float = K.CARD_TEST_MAX_AMOUNT
    high_risk_level: str = K.HIGH_RISK_MERCHANT_LEVEL
    min_bucket_seconds: int = 3600

    @property
    def horizon_seconds(self) -> int:
        return int(math.ceil(max(self.travel_max_minutes * 60, self.velocity_seconds, self.card_test_seconds, 1)))

    @property
    def bucket_seconds(self) -> int:
        return max(self.horizon_seconds, self.min_bucket_seconds)


DEFAULT_RULES = RuleConfig()


def _epoch_micros(df: DataFrame, ts: str) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz" if is_ntz(df, ts) else "timestamp")
    return F.timestamp_diff("MICROSECOND", epoch, F.col(ts))


def _with_context_buckets(df: DataFrame, ts: str, cfg: RuleConfig) -> DataFrame:
    """Add ``_bucket`` and ``_context``: each row in its own bucket, and rows
    within the horizon of the next bucket once more as context there."""
    b_us, h_us = cfg.bucket_seconds * 1_000_000, cfg.horizon_seconds * 1_000_000
    micros = _epoch_micros(df, ts)
    # exact integer floor division (micros - pmod is a multiple of the bucket)
    bucket = ((micros - F.pmod(micros, F.lit(b_us))) / F.lit(b_us)).cast("long")
    near_next = micros >= (bucket + 1) * F.lit(b_us) - F.lit(h_us)
    copies = F.when(near_next, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (df.withColumn("_base", bucket)
              .withColumn("_copy", F.explode(copies))
              .withColumn("_bucket", F.col("_base") + F.col("_copy"))
              .withColumn("_context", F.col("_copy") == 1)
              .drop("_base", "_copy"))


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _row_flags(cfg: RuleConfig) -> dict[str, Column]:
    """The rules that look at one row and its lookups only."""
    return {
        "rule_high_value": _flag(F.col("amount") > F.lit(cfg.high_value_amount)),
        "rule_new_device": ~F.col("device_id").eqNullSafe(F.col("trusted_device_id")),
        "rule_high_risk_merchant": F.col("merchant_risk").eqNullSafe(F.lit(cfg.high_risk_level)),
        "rule_blacklisted_merchant": _flag(F.col("is_blacklisted")),
        "rule_international": _flag(F.col("is_international")),
    }


def rule_flags(transactions: DataFrame, customers: DataFrame, merchants: DataFrame,
               cfg: RuleConfig = DEFAULT_RULES, history: DataFrame | None = None) -> DataFrame:
    """Transactions with one boolean column per rule (never null).

    ``history`` (same columns) holds earlier transactions that the history
    rules look back at but that are not scored again (a streaming micro-batch
    passes the tail of the previous batches here).
    """
    ts = "transaction_timestamp"
    cust = customers.select("customer_id", "trusted_device_id")
    merch = merchants.select("merchant_id", "merchant_risk", "is_blacklisted")
    t = transactions.withColumn("_history", F.lit(False))
    if history is not None:
        t = t.unionByName(history.select(*transactions.columns).withColumn("_history", F.lit(True)))
    t = (t.join(cust, "customer_id", "left")
         .join(merch, "merchant_id", "left"))
    row_flags = _row_flags(cfg)
    t = t.select(*transactions.columns, "_history", *[c.alias(n) for n, c in row_flags.items()])
    # explicit shuffle on (customer, bucket): an input already hash-partitioned
    # by customer alone would otherwise be reused and keep a hot customer in one task
    t = _with_context_buckets(t, ts, cfg).repartition("customer_id", "_bucket")
    w = Window.partitionBy("customer_id", "_bucket").orderBy(
        F.col(ts).asc_nulls_first(), F.col("transaction_id").asc_nulls_first())
    cur = F.col(ts)
    prev_ts, prev_city = F.lag(ts, 1).over(w), F.lag("city", 1).over(w)
    vel_ts = F.lag(ts, cfg.velocity_count).over(w)
    card_ts = F.lag(ts, cfg.card_test_count).over(w)
    amount = F.col("amount")

    flags = {
        "rule_impossible_travel": _flag((prev_city == F.lit(cfg.travel_from)) &
                                       (F.col("city") == F.lit(cfg.travel_to)) &
                                       (minutes_between(prev_ts, cur) <= F.lit(cfg.travel_max_minutes))),
        "rule_velocity": _flag(vel_ts >= cur - interval_seconds(cfg.velocity_seconds)),
        "rule_card_testing": _flag((amount >= F.lit(cfg.card_test_min)) & (amount <= F.lit(cfg.card_test_max)) &
                                  (card_ts >= cur - interval_seconds(cfg.card_test_seconds))),
    }
    out = t.select(*transactions.columns, "_context", "_history",
                   *[flags[c].alias(c) if c in flags else F.col(c) for c in RULE_COLUMNS.values()])
    return out.filter(~F.col("_context") & ~F.col("_history")).drop("_context", "_history")


def score(flagged: DataFrame) -> DataFrame:
    """Add fraud_score, fraud_reason and dominant_reason from the rule flags."""
    weighted = [F.when(F.col(RULE_COLUMNS[r]), F.lit(wt)).otherwise(F.lit(0)) for r, wt in K.RULE_WEIGHTS]
    total = weighted[0]
    for x in weighted[1:]:
        total = total + x
    first = F.lit(None).cast("string")
    for r, _ in reversed(K.RULE_WEIGHTS):
        first = F.when(F.col(RULE_COLUMNS[r]), F.lit(r)).otherwise(first)
    # greatest weight wins; on equal weight the earlier rule (smaller position)
    candidates = [F.when(F.col(RULE_COLUMNS[r]), F.struct(F.lit(wt).alias("w"), F.lit(-i).alias("p"),
                                                          F.lit(r).alias("r")))
                  for i, (r, wt) in enumerate(K.RULE_WEIGHTS)]
    dominant = F.greatest(*candidates)
    return flagged.select(
        "*",
        F.least(F.lit(K.SCORE_CAP), total).alias("fraud_score"),
        F.coalesce(first, F.lit(K.NORMAL_REASON)).alias("fraud_reason"),
        F.coalesce(dominant.getField("r"), F.lit(K.NORMAL_REASON)).alias("dominant_reason"),
    )


def score_transactions(transactions: DataFrame, customers: DataFrame, merchants: DataFrame,
                       cfg: RuleConfig = DEFAULT_RULES, history: DataFrame | None = None) -> DataFrame:
    """Transactions with rule flags, fraud_score, fraud_reason, dominant_reason."""
    return score(rule_flags(transactions, customers, merchants, cfg, history))


def rule_hits(transactions: DataFrame, customers: DataFrame, merchants: DataFrame, reason: str,
              cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """Transactions for which one rule holds. A rule on one row needs no window and no
    shuffle of the transactions, only the lookup that it names."""
    column = RULE_COLUMNS[reason]
    if column in _row_flags(cfg):
        t = transactions
        if column == "rule_new_device":
            t = t.join(customers.select("customer_id", "trusted_device_id"), "customer_id", "left")
        if column in ("rule_high_risk_merchant", "rule_blacklisted_merchant"):
            t = t.join(merchants.select("merchant_id", "merchant_risk", "is_blacklisted"), "merchant_id", "left")
        hits = t.filter(_row_flags(cfg)[column])
    else:
        hits = rule_flags(transactions, customers, merchants, cfg).filter(F.col(column))
    return hits.select("transaction_id", "customer_id", "transaction_timestamp", "amount")
