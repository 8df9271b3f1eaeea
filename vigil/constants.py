"""Fixed values that results depend on.

FIXED VALUES (must stay as they are for results to match the monitored
application): alert types, id prefixes, watermark, window sizes, fraud-rule
thresholds, weights and evaluation order.
"""

from __future__ import annotations

# ---- fixed values: alerts -------------------------------------------------
ALERT_HIGH_VALUE = "HIGH_VALUE_TRANSACTION"
ALERT_FRAUD_WATCHLIST = "FRAUD_WATCHLIST_MATCH"
ALERT_ID_PREFIX = "ALERT"
FRAUD_ALERT_ID_PREFIX = "FRAUD"

# ---- fixed values: event time ---------------------------------------------
WATERMARK_DELAY = "5 minutes"
TUMBLING_WINDOW = "1 minute"
SLIDING_WINDOW = "5 minutes"
SLIDING_SLIDE = "1 minute"

# ---- fixed values: fraud rules ----------------------------------------------
# Reasons in evaluation order with their weights; score is capped at 100.
RULE_WEIGHTS = [
    ("HIGH_VALUE_TRANSACTION", 40),
    ("IMPOSSIBLE_TRAVEL", 50),
    ("NEW_DEVICE", 20),
    ("HIGH_RISK_MERCHANT", 25),
    ("BLACKLISTED_MERCHANT", 60),
    ("INTERNATIONAL_TRANSACTION", 25),
    ("VELOCITY_FRAUD", 45),
    ("CARD_TESTING", 30),
]
NORMAL_REASON = "NORMAL"
SCORE_CAP = 100
# Thresholds: amount above 100000; travel Delhi -> London within 20 minutes;
# 5 earlier transactions within 30 seconds; card testing 5..20 with 3 earlier
# transactions within 60 seconds; history kept per customer: 50 transactions.
HIGH_VALUE_AMOUNT = 100000.0
TRAVEL_FROM_CITY = "Delhi"
TRAVEL_TO_CITY = "London"
TRAVEL_MAX_MINUTES = 20.0
VELOCITY_COUNT = 5
VELOCITY_SECONDS = 30
CARD_TEST_COUNT = 3
CARD_TEST_SECONDS = 60
CARD_TEST_MIN_AMOUNT = 5.0
CARD_TEST_MAX_AMOUNT = 20.0
HIGH_RISK_MERCHANT_LEVEL = "HIGH"

# ---- fixed values: notifications -------------------------------------------
# subjects (printf style): alert id; risk level and alert id
HIGH_VALUE_SUBJECT_FORMAT = "High Value Transaction Alert - %s"
FRAUD_SUBJECT_FORMAT = "FRAUD ALERT - %s Risk - %s"
MASK_NULL = "****"
MISSING_TEXT = "N/A"

# ---- fixed values: reports ---------------------------------------------------
ACTIVE_WATCHLIST_STATUS = "active"
TOP_K = 10
