"""Schemas and column lists of the bronze, silver and gold tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Transaction message as produced to the topic (fixed field list of the feed).
TRANSACTION_SCHEMA = StructType([
    StructField("transaction_id", StringType()),
    StructField("customer_id", StringType()),
    StructField("card_number", StringType()),
    StructField("merchant_id", StringType()),
    StructField("merchant_name", StringType()),
    StructField("merchant_category", StringType()),
    StructField("amount", DoubleType()),
    StructField("currency", StringType()),
    StructField("transaction_type", StringType()),
    StructField("payment_channel", StringType()),
    StructField("device_id", StringType()),
    StructField("city", StringType()),
    StructField("country", StringType()),
    StructField("transaction_timestamp", TimestampType()),
    StructField("is_international", BooleanType()),
    StructField("status", StringType()),
])
TRANSACTION_COLUMNS = [f.name for f in TRANSACTION_SCHEMA.fields]

# Fixed schema of the Kafka source (what spark.read/readStream.format("kafka") yields).
KAFKA_SCHEMA = StructType([
    StructField("key", StringType()),
    StructField("value", StringType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
    StructField("timestampType", IntegerType()),
])


# Watchlist file records: all text as landed (fixed field list of the feed).
WATCHLIST_COLUMNS = [
    "watchlist_id", "watch_type", "entity_id", "risk_level", "action", "reason_code",
    "reason_description", "status", "effective_from", "reported_by", "reported_source",
    "country", "city",
]
WATCHLIST_FILE_SCHEMA = StructType([StructField(c, StringType()) for c in WATCHLIST_COLUMNS])
WATCHLIST_EFFECTIVE_FROM_FORMAT = "dd-MMM-yyyy HH:mm:ss"

# Customer master data (fixed column list of the source table, which has update_timestamp in addition).
CUSTOMER_SCHEMA = StructType([
    StructField("customer_id", StringType()),
    StructField("first_name", StringType()),
    StructField("last_name", StringType()),
    StructField("gender", StringType()),
    StructField("age", IntegerType()),
    StructField("city", StringType()),
    StructField("state", StringType()),
    StructField("country", StringType()),
    StructField("annual_income", DecimalType(18, 2)),
    StructField("customer_segment", StringType()),
    StructField("account_open_date", StringType()),
    StructField("risk_score", IntegerType()),
    StructField("preferred_spending_min", DecimalType(18, 2)),
    StructField("preferred_spending_max", DecimalType(18, 2)),
    StructField("preferred_city", StringType()),
    StructField("preferred_country", StringType()),
    StructField("trusted_device_id", StringType()),
    StructField("card_number", StringType()),
    StructField("card_type", StringType()),
    StructField("email", StringType()),
    StructField("transaction_limit", DecimalType(18, 2)),
])
CUSTOMER_COLUMNS = [f.name for f in CUSTOMER_SCHEMA.fields]
CUSTOMER_SOURCE_SCHEMA = StructType(CUSTOMER_SCHEMA.fields + [StructField("update_timestamp", TimestampType())])

MERCHANT_SCHEMA = StructType([
    StructField("merchant_id", StringType()),
    StructField("merchant_name", StringType()),
    StructField("merchant_category", StringType()),
    StructField("city", StringType()),
    StructField("country", StringType()),
    StructField("merchant_risk", StringType()),
    StructField("is_blacklisted", BooleanType()),
])
MERCHANT_COLUMNS = [f.name for f in MERCHANT_SCHEMA.fields]


# The alert tables' columns and their order, with the column of the transaction (t), customer (c) or
# watchlist entry (w) that each one holds. @ marks those that are made: @id of the parts named, @type, @time, @name.
HIGH_VALUE_ALERT = (
    ("alert_id", "@id t.transaction_id"), ("alert_type", "@type"), ("alert_timestamp", "@time"),
    ("transaction_id", "t.transaction_id"), ("customer_id", "t.customer_id"), ("customer_email", "c.email"), ("customer_name", "@name"),
    ("transaction_amount", "t.amount"), ("transaction_limit", "c.transaction_limit"), ("currency", "t.currency"),
    ("merchant_name", "t.merchant_name"), ("merchant_category", "t.merchant_category"), ("transaction_type", "t.transaction_type"),
    ("payment_channel", "t.payment_channel"), ("city", "t.city"), ("country", "t.country"), ("is_international", "t.is_international"),
    ("transaction_timestamp", "t.transaction_timestamp"), ("status", "t.status"),
)
FRAUD_CARD_ALERT = (
    ("alert_id", "@id t.transaction_id w.watchlist_id"), ("alert_type", "@type"), ("alert_timestamp", "@time"),
    ("transaction_id", "t.transaction_id"), ("customer_id", "t.customer_id"), ("customer_email", "c.email"), ("customer_name", "@name"),
    ("card_number", "t.card_number"), ("amount", "t.amount"), ("currency", "t.currency"),
    ("merchant_id", "t.merchant_id"), ("merchant_name", "t.merchant_name"), ("merchant_category", "t.merchant_category"),
    ("transaction_type", "t.transaction_type"), ("payment_channel", "t.payment_channel"), ("device_id", "t.device_id"),
    ("transaction_city", "t.city"), ("transaction_country", "t.country"), ("transaction_timestamp", "t.transaction_timestamp"),
    ("is_international", "t.is_international"), ("transaction_status", "t.status"),
    ("watchlist_id", "w.watchlist_id"), ("watch_type", "w.watch_type"), ("risk_level", "w.risk_level"), ("action", "w.action"),
    ("reason_code", "w.reason_code"), ("reason_description", "w.reason_description"), ("watchlist_effective_from", "w.effective_from"),
    ("reported_by", "w.reported_by"), ("reported_source", "w.reported_source"), ("watchlist_city", "w.city"), ("watchlist_country", "w.country"),
)
FRAUD_CARD_ALERT_COLUMNS = [name for name, _ in FRAUD_CARD_ALERT]
