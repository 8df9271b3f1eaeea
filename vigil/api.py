"""One import point for the pipeline functions, under their usual names.

    from vigil.api import parse_transactions, high_value_alerts, transaction_counts

The functions take the same positional arguments as the transformation
functions of the monitored application (DataFrame in, DataFrame out), plus
optional keyword arguments (``now`` / ``alert_time`` for reproducible runs,
variants of the watchlist join, rule settings).
"""

from vigil.operators.alerts import (  # noqa: F401
    fraud_card_alerts,
    fraud_card_alerts_bounded,
    fraud_card_alerts_snapshot,
    high_value_alerts,
    unknown_customer_transactions,
)
from vigil.operators.notify import (  # noqa: F401
    fraud_card_notifications,
    high_value_notifications,
    masked_cards,
)
from vigil.operators.quality import (  # noqa: F401
    CUSTOMER_EXPECTATIONS,
    TRANSACTION_EXPECTATIONS,
    expect,
    expectation_report,
    keep_valid,
    quarantine,
    quarantine_messages,
)
from vigil.operators.rules import RuleConfig, score_transactions  # noqa: F401
from vigil.operators.silver import (  # noqa: F401
    apply_changes,
    clean_customers,
    clean_watchlist,
    drop_duplicate_transactions,
    kafka_to_bronze,
    latest_per_key,
    parse_transactions,
    watchlist_to_bronze,
)
from vigil.operators.windows import transaction_counts  # noqa: F401
from vigil.sources.kafka import kafka_read_options, topic_profile  # noqa: F401

__all__ = [
    "kafka_read_options", "kafka_to_bronze", "parse_transactions", "watchlist_to_bronze", "clean_watchlist",
    "clean_customers", "high_value_alerts", "fraud_card_alerts", "transaction_counts",
    "fraud_card_alerts_bounded", "fraud_card_alerts_snapshot", "unknown_customer_transactions",
    "latest_per_key", "apply_changes", "drop_duplicate_transactions", "keep_valid", "quarantine",
    "quarantine_messages", "expect", "expectation_report", "TRANSACTION_EXPECTATIONS", "CUSTOMER_EXPECTATIONS",
    "score_transactions", "RuleConfig", "high_value_notifications", "fraud_card_notifications", "masked_cards",
    "topic_profile",
]
