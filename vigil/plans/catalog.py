"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query builds the domain frames from the supplied tables (whole tables,
no sampling) and applies one library operator. Timestamps in results are
returned as ``timestamp_ntz`` (wall-clock UTC) so that they compare equal
whatever the time zone of the process reading them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from vigil.operators import alerts as AL
from vigil.operators import silver as SV
from vigil.session import apply_runtime_conf
from vigil.sources import adapter as A

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def as_ntz(df: DataFrame) -> DataFrame:
    """Cast every ``timestamp`` column to ``timestamp_ntz`` (session zone UTC)."""
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_runtime_conf(spark)
            return as_ntz(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


class Domain:
    """Domain frames of one test-data folder (built lazily, plans only)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def transactions(self) -> DataFrame:
        return A.transactions(self.spark, self.sf_dir)

    def customers(self) -> DataFrame:
        return SV.clean_customers(A.customers_source(self.spark, self.sf_dir))

    def watchlist(self) -> DataFrame:
        bronze = SV.watchlist_to_bronze(
            A.watchlist_records(self.spark, self.sf_dir).withColumn("file_path", F.lit("adapter")))
        return SV.clean_watchlist(bronze)

    def merchants(self) -> DataFrame:
        return A.merchants(self.spark, self.sf_dir)

    def hv_alerts(self) -> DataFrame:
        return AL.high_value_alerts(self.transactions(), self.customers(), alert_time="transaction_timestamp")

    def fraud_alerts(self) -> DataFrame:
        return AL.fraud_card_alerts(self.transactions(), self.watchlist(), self.customers(),
                                    alert_time="transaction_timestamp")


@register("high_value_alerts")
def q_high_value_alerts(spark, sf_dir):
    """Transactions above the customer's limit."""
    return Domain(spark, sf_dir).hv_alerts()


@register("fraud_card_alerts")
def q_fraud_card_alerts(spark, sf_dir):
    """J2+J3: transactions whose card is on the watchlist, with the customer."""
    return Domain(spark, sf_dir).fraud_alerts()


# ---------------------------------------------------------------- ingest / silver

def _bronze(spark, sf_dir, dirty=False) -> DataFrame:
    from vigil.operators.silver import kafka_to_bronze
    return kafka_to_bronze(A.kafka_messages(spark, sf_dir, dirty=dirty))


@register("bronze_transactions")
def q_bronze_transactions(spark, sf_dir):
    """Kafka frame -> bronze (value checked through its transaction id)."""
    b = _bronze(spark, sf_dir)
    return b.select("key", "topic", "partition", "offset", "timestamp", "timestampType",
                    F.get_json_object("value", "$.transaction_id").alias("value_transaction_id"))


@register("topic_profile")
def q_topic_profile(spark, sf_dir):
    """S3: messages per topic partition with offset and time range."""
    from vigil.sources.kafka import topic_profile
    return topic_profile(_bronze(spark, sf_dir))


@register("silver_transactions")
def q_silver_transactions(spark, sf_dir):
    """Parse the message JSON into typed columns with Kafka lineage."""
    s = SV.parse_transactions(_bronze(spark, sf_dir))
    return s.drop("bronze_ingestion_timestamp", "silver_ingestion_timestamp")


@register("silver_watchlist")
def q_silver_watchlist(spark, sf_dir):
    """Watchlist ids and codes upper-cased, effective_from parsed."""
    return Domain(spark, sf_dir).watchlist().drop("source_file", "bronze_ingestion_timestamp",
                                                  "silver_ingestion_timestamp")


@register("silver_customers")
def q_silver_customers(spark, sf_dir):
    """Customer columns with account_open_date as a date."""
    return Domain(spark, sf_dir).customers().drop("silver_ingestion_timestamp")


def _dirty_silver(spark, sf_dir) -> DataFrame:
    return SV.parse_transactions(_bronze(spark, sf_dir, dirty=True))


@register("expect_drop_transactions")
def q_expect_drop_transactions(spark, sf_dir):
    """Rows kept after the drop expectations on dirty input."""
    from vigil.operators.quality import keep_valid
    return keep_valid(_dirty_silver(spark, sf_dir)).select(
        "transaction_id", "customer_id", "card_number", "merchant_id", "amount", "kafka_offset")


@register("quarantine_transactions")
def q_quarantine_transactions(spark, sf_dir):
    """Rows removed by the drop expectations, with the failed rule names."""
    from vigil.operators.quality import quarantine
    q = quarantine(_dirty_silver(spark, sf_dir))
    return q.select("kafka_offset", "transaction_id",
                    F.array_join("failed_expectations", ",").alias("failed_expectations"))


@register("expectation_report")
def q_expectation_report(spark, sf_dir):
    """P5: failed-record count per expectation (drop and warn)."""
    from vigil.operators.quality import expectation_report
    return expectation_report(_dirty_silver(spark, sf_dir))


@register("expect_drop_customers")
def q_expect_drop_customers(spark, sf_dir):
    """Customers kept by the customer expectations."""
    from vigil.operators.quality import CUSTOMER_EXPECTATIONS, keep_valid
    return keep_valid(Domain(spark, sf_dir).customers(), CUSTOMER_EXPECTATIONS).select(
        "customer_id", "risk_score", "transaction_limit")


# ---------------------------------------------------------------- joins

@register("fraud_card_alerts_bounded")
def q_fraud_card_alerts_bounded(spark, sf_dir):
    """Watchlist match within 7 days from effective_from."""
    d = Domain(spark, sf_dir)
    return AL.fraud_card_alerts_bounded(d.transactions(), d.watchlist(), d.customers(), lookback="7 days",
                                        alert_time="transaction_timestamp")


@register("fraud_card_alerts_snapshot")
def q_fraud_card_alerts_snapshot(spark, sf_dir):
    """Match against the latest watchlist snapshot, active entries only."""
    d = Domain(spark, sf_dir)
    return AL.fraud_card_alerts_snapshot(d.transactions(), d.watchlist(), d.customers(),
                                         alert_time="transaction_timestamp")


@register("unknown_customer_transactions")
def q_unknown_customer_transactions(spark, sf_dir):
    """Transactions with no customer, against all customers."""
    d = Domain(spark, sf_dir)
    return AL.unknown_customer_transactions(d.transactions(), d.customers()).select(
        "transaction_id", "customer_id", "amount")


# ---------------------------------------------------------------- windows

@register("tx_count_tumbling")
def q_tx_count_tumbling(spark, sf_dir):
    """A1: transactions per 1-minute tumbling window."""
    from vigil.operators.windows import tumbling_counts
    return tumbling_counts(Domain(spark, sf_dir).transactions())


@register("tx_count_sliding")
def q_tx_count_sliding(spark, sf_dir):
    """A2: transactions per 5-minute window sliding by 1 minute."""
    from vigil.operators.windows import sliding_counts
    return sliding_counts(Domain(spark, sf_dir).transactions())


# ---------------------------------------------------------------- customers

def _customer_log(spark, sf_dir) -> DataFrame:
    return A.customers_source(spark, sf_dir).unionByName(A.customer_changes(spark, sf_dir))


@register("customers_latest")
def q_customers_latest(spark, sf_dir):
    """Latest row per customer in the change log."""
    return SV.latest_per_key(_customer_log(spark, sf_dir), "customer_id", "update_timestamp")


@register("customers_apply_changes")
def q_customers_apply_changes(spark, sf_dir):
    """Upsert of the change rows into the snapshot, cleaned, with change type."""
    merged = SV.apply_changes(A.customers_source(spark, sf_dir), A.customer_changes(spark, sf_dir))
    cleaned = SV.clean_customers(merged, keep=("update_timestamp", "change_type"))
    return cleaned.drop("silver_ingestion_timestamp")


# ---------------------------------------------------------------- fraud rules

def _test_rules():
    from vigil.operators.rules import RuleConfig
    # larger limits than the defaults: the test events are minutes apart
    return RuleConfig(high_value_amount=300.0, travel_max_minutes=1440.0, velocity_count=5,
                      velocity_seconds=2 * 86400, card_test_count=3, card_test_seconds=86400)


def _scored(spark, sf_dir) -> DataFrame:
    from vigil.operators.rules import score_transactions
    d = Domain(spark, sf_dir)
    return score_transactions(d.transactions(), d.customers(), d.merchants(), _test_rules())


def _rule_query(reason: str):
    def q(spark, sf_dir):
        from vigil.operators.rules import rule_hits
        d = Domain(spark, sf_dir)
        return rule_hits(d.transactions(), d.customers(), d.merchants(), reason, _test_rules())
    q.__doc__ = f"R: transactions for which {reason} holds."
    return q


for _reason, _key in [("HIGH_VALUE_TRANSACTION", "rule_high_value"),
                      ("IMPOSSIBLE_TRAVEL", "rule_impossible_travel"),
                      ("NEW_DEVICE", "rule_new_device"),
                      ("HIGH_RISK_MERCHANT", "rule_high_risk_merchant"),
                      ("BLACKLISTED_MERCHANT", "rule_blacklisted_merchant"),
                      ("INTERNATIONAL_TRANSACTION", "rule_international"),
                      ("VELOCITY_FRAUD", "rule_velocity"),
                      ("CARD_TESTING", "rule_card_testing")]:
    register(_key)(_rule_query(_reason))


@register("fraud_scores")
def q_fraud_scores(spark, sf_dir):
    """Capped score and first reason per transaction."""
    return _scored(spark, sf_dir).select("transaction_id", "customer_id", "fraud_score", "fraud_reason")


@register("fraud_dominant_reason")
def q_fraud_dominant_reason(spark, sf_dir):
    """The reason with the greatest weight per transaction."""
    return _scored(spark, sf_dir).select("transaction_id", "fraud_score", "dominant_reason")


# ---------------------------------------------------------------- reports

def _alerts(d: Domain) -> DataFrame:
    from vigil.plans.reports import alerts_union
    return alerts_union(d.fraud_alerts(), d.hv_alerts())


def _report(name: str, build):
    def q(spark, sf_dir):
        return build(Domain(spark, sf_dir))
    q.__doc__ = f"D: report {name} as of {A.AS_OF}."
    register(name)(q)


def _register_reports():
    from vigil.plans import reports as R
    _report("rpt_high_risk_customers", lambda d: R.rpt_high_risk_customers(d.customers()))
    _report("rpt_transactions_today", lambda d: R.rpt_transactions_today(d.transactions(), A.AS_OF))
    _report("rpt_avg_amount_today", lambda d: R.rpt_avg_amount_today(d.transactions(), A.AS_OF))
    _report("rpt_alerts_today", lambda d: R.rpt_alerts_today(_alerts(d), A.AS_OF))
    _report("rpt_alert_status", lambda d: R.rpt_alert_status(_alerts(d), A.AS_OF))
    _report("rpt_top_customers", lambda d: R.rpt_top_customers(_alerts(d), A.AS_OF))
    _report("rpt_alert_trends", lambda d: R.rpt_alert_trends(_alerts(d), A.AS_OF))
    _report("rpt_alert_types", lambda d: R.rpt_alert_types(_alerts(d), A.AS_OF))
    _report("rpt_volume_by_minute", lambda d: R.rpt_volume_by_minute(d.transactions(), A.AS_OF))
    _report("rpt_intl_vs_domestic", lambda d: R.rpt_intl_vs_domestic(d.transactions(), A.AS_OF))
    _report("rpt_top_merchants", lambda d: R.rpt_top_merchants(d.transactions(), A.AS_OF))
    _report("rpt_amount_by_category", lambda d: R.rpt_amount_by_category(d.transactions(), A.AS_OF))
    _report("rpt_payment_channels", lambda d: R.rpt_payment_channels(d.transactions(), A.AS_OF))
    _report("rpt_by_country", lambda d: R.rpt_by_country(d.transactions(), A.AS_OF))
    _report("rpt_watchlist_risk", lambda d: R.rpt_watchlist_risk(d.watchlist()))
    _report("duplicate_transaction_ids", lambda d: R.duplicate_transaction_ids(d.transactions()))


_register_reports()


# ---------------------------------------------------------------- notifications

@register("outbox_high_value")
def q_outbox_high_value(spark, sf_dir):
    """Recipient, subject and HTML body per high-value alert."""
    from vigil.operators.notify import high_value_notifications
    return high_value_notifications(Domain(spark, sf_dir).hv_alerts())


@register("outbox_fraud_card")
def q_outbox_fraud_card(spark, sf_dir):
    """Recipient, subject and HTML body per watchlist alert (card masked)."""
    from vigil.operators.notify import fraud_card_notifications
    return fraud_card_notifications(Domain(spark, sf_dir).fraud_alerts())


@register("mask_card")
def q_mask_card(spark, sf_dir):
    """Last four characters of each alerted card."""
    from vigil.operators.notify import masked_cards
    return masked_cards(Domain(spark, sf_dir).fraud_alerts())


# ---------------------------------------------------------------- watchlist feed

@register("watchlist_resume")
def q_watchlist_resume(spark, sf_dir):
    """Records above the highest id already landed (keys <= 1000 landed)."""
    from vigil.sources.files import watchlist_resume
    source = A.watchlist_records(spark, sf_dir)
    landed = source.filter(F.regexp_extract("watchlist_id", r"(\d+)$", 1).cast("long")
                           <= A.WATCHLIST_PUBLISHED_MAX_KEY)
    return watchlist_resume(source, landed).select("watchlist_id", "entity_id", "risk_level")


@register("watchlist_rescued")
def q_watchlist_rescued(spark, sf_dir):
    """Fields outside the watchlist schema kept as JSON text."""
    from vigil.sources.files import parse_watchlist_json
    parsed = parse_watchlist_json(A.watchlist_messages(spark, sf_dir))
    return parsed.select("watchlist_id", "entity_id", "_rescued_data")


# streaming and I/O queries register themselves on import
from vigil.plans import streams as _streams  # noqa: E402,F401


# ---------------------------------------------------------------- replayed messages

def _replayed_silver(spark, sf_dir) -> DataFrame:
    """The topic read twice for its last day (a consumer restart re-delivers
    the messages of 2024-01-30 with new offsets)."""
    from vigil.operators.silver import kafka_to_bronze
    msgs = A.kafka_messages(spark, sf_dir)
    again = (msgs.filter(F.col("timestamp") >= F.lit(A.REPLAY_FROM).cast("timestamp"))
             .withColumn("offset", F.col("offset") + F.lit(A.REPLAY_OFFSET)))
    return SV.parse_transactions(kafka_to_bronze(msgs.unionByName(again)))


@register("replayed_duplicate_ids")
def q_replayed_duplicate_ids(spark, sf_dir):
    """Transaction ids delivered more than once."""
    from vigil.plans.reports import duplicate_transaction_ids
    return duplicate_transaction_ids(_replayed_silver(spark, sf_dir))


@register("dedup_transactions")
def q_dedup_transactions(spark, sf_dir):
    """One row per message after a replay (equal payloads collapse)."""
    from vigil.schemas import TRANSACTION_COLUMNS
    return SV.drop_duplicate_transactions(_replayed_silver(spark, sf_dir)).select(*TRANSACTION_COLUMNS)


@register("fraud_card_alerts_salted")
def q_fraud_card_alerts_salted(spark, sf_dir):
    """J2 with each card split into 8 salted sub-keys (hot cards over many partitions)."""
    d = Domain(spark, sf_dir)
    return AL.fraud_card_alerts(d.transactions(), d.watchlist(), d.customers(), alert_time="transaction_timestamp",
                                salt=8)


@register("fraud_card_alerts_heavy")
def q_fraud_card_alerts_heavy(spark, sf_dir):
    """J2 with as many sub-keys for a card as it has ten-thousandths of the transactions, by merged daily sketches."""
    from vigil.operators.skew import card_salts, card_sketches
    d = Domain(spark, sf_dir)
    daily = card_sketches(d.transactions().withColumn("day", F.to_date("transaction_timestamp")), "day")
    return AL.fraud_card_alerts(d.transactions(), d.watchlist(), d.customers(), alert_time="transaction_timestamp",
                                salt=card_salts(daily, spread=10_000))


@register("high_value_alerts_asof")
def q_high_value_alerts_asof(spark, sf_dir):
    """High-value alerts by the limit at the time of the transaction (limits change within the month)."""
    d = Domain(spark, sf_dir)
    return AL.high_value_alerts_asof(d.transactions(), _customer_log(spark, sf_dir), alert_time="transaction_timestamp")


@register("transactions_rescued")
def q_transactions_rescued(spark, sf_dir):
    """Messages with what the typed parse can't hold kept per field: every 13th amount is sent as text, and every
    17th message has a nested field that the schema doesn't know."""
    from vigil.operators.rescue import rescued_transactions
    raw, eid = F.col("value"), F.col("offset")
    raw = F.when(eid % 13 == 0, F.regexp_replace(raw, '"amount":([^,]+)', '"amount":"$1"')).otherwise(raw)
    risk = F.concat(F.lit(',"device_risk":{"level":'), eid % 5, F.lit(',"by":"app"}}'))
    raw = F.when(eid % 17 == 0, F.concat(F.regexp_replace(raw, "}$", ""), risk)).otherwise(raw)
    return rescued_transactions(_bronze(spark, sf_dir).withColumn("value", raw)).select(
        "transaction_id", "amount", "transaction_timestamp", "_rescued_data")
