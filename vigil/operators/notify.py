"""Notification rows for the outbox: recipient, subject and HTML body per alert.

Bodies are built with column expressions on the executors (no collect to the
driver). The layout of each body is a list of literal HTML pieces and typed
fields; ``render`` turns it into one ``concat`` column. Text from the data is
HTML-escaped; the card number appears only as its last four characters. A
row whose recipient or amount is missing is marked ``INVALID`` instead of
failing the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil import constants as K
from vigil.functions.columns import html_text, mask_card, money, or_missing, timestamp_text

# Field kinds: text (escaped, N/A when missing), money (1,234.50), ts (date and
# time text), card (last four), yesno (boolean flag).


def _item(label: str, *fields) -> list:
    return [f"<li><b>{label}:</b> ", *fields, "</li>\n"]


HIGH_VALUE_BODY = [
    "<html><body>\n<h2>High Value Transaction Alert</h2>\n<p>Dear ", ("text", "customer_name"),
    ",</p>\n<p>A transaction exceeded your configured limit.</p>\n<ul>\n",
    *_item("Transaction ID", ("text", "transaction_id")),
    *_item("Amount", ("text", "currency"), " ", ("money", "transaction_amount")),
    *_item("Your Limit", ("text", "currency"), " ", ("money", "transaction_limit")),
    *_item("Merchant", ("text", "merchant_name"), " (", ("text", "merchant_category"), ")"),
    *_item("Location", ("text", "city"), ", ", ("text", "country")),
    *_item("Date/Time", ("ts", "transaction_timestamp")),
    "</ul>\n<p>If you did not authorize this transaction, contact the fraud department.</p>\n<p>Alert ID: ",
    ("text", "alert_id"), "</p>\n</body></html>",
]

FRAUD_CARD_BODY = [
    "<html><body>\n<h2>FRAUD ALERT - Suspicious Activity Detected</h2>\n<p>Dear ", ("text", "customer_name"),
    ",</p>\n<p>A transaction on your card matches our fraud watchlist.</p>\n<h3>Fraud Details</h3>\n<ul>\n",
    *_item("Alert Type", ("text", "alert_type")),
    *_item("Risk Level", ("text", "risk_level")),
    *_item("Watchlist Type", ("text", "watch_type")),
    *_item("Reason", ("text", "reason_description")),
    *_item("Action Required", ("text", "action")),
    "</ul>\n<h3>Transaction Details</h3>\n<ul>\n",
    *_item("Transaction ID", ("text", "transaction_id")),
    *_item("Card Number", ("card", "card_number")),
    *_item("Amount", ("text", "currency"), " ", ("money", "amount")),
    *_item("Merchant", ("text", "merchant_name"), " (", ("text", "merchant_category"), ")"),
    *_item("Transaction Type", ("text", "transaction_type")),
    *_item("Payment Channel", ("text", "payment_channel")),
    *_item("Location", ("text", "transaction_city"), ", ", ("text", "transaction_country")),
    *_item("International", ("yesno", "is_international")),
    *_item("Date/Time", ("ts", "transaction_timestamp")),
    *_item("Status", ("text", "transaction_status")),
    "</ul>\n<h3>Watchlist Information</h3>\n<ul>\n",
    *_item("Watchlist ID", ("text", "watchlist_id")),
    *_item("Reported By", ("text", "reported_by")),
    *_item("Reported Source", ("text", "reported_source")),
    *_item("Watchlist Location", ("text", "watchlist_city"), ", ", ("text", "watchlist_country")),
    *_item("Effective From", ("ts", "watchlist_effective_from")),
    "</ul>\n<p>Alert ID: ", ("text", "alert_id"), "<br>\nAlert Timestamp: ", ("ts", "alert_timestamp"),
    "</p>\n<p>Never share this message or your card details with anyone.</p>\n</body></html>",
]


def card_text(name: str) -> Column:
    """``****`` and the last four characters; ``****`` alone for a missing card."""
    known = F.nullif(F.col(name), F.lit("")).isNotNull()
    return F.when(known, F.concat(F.lit("****"), mask_card(name))).otherwise(F.lit("****"))


def _field(kind: str, name: str) -> Column:
    if kind == "text":
        return html_text(name)
    if kind == "money":
        return or_missing(money(name))
    if kind == "ts":
        return or_missing(timestamp_text(name))
    if kind == "card":
        return html_text(card_text(name))
    if kind == "yesno":
        return F.when(F.coalesce(F.col(name), F.lit(False)), F.lit("Yes")).otherwise(F.lit("No"))
    raise ValueError(kind)


def render(layout: list) -> Column:
    """One string column from a body layout (never null)."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else _field(*p) for p in layout])


def _delivery_status(recipient: str, amount: str) -> Column:
    r = F.col(recipient)
    ok = r.isNotNull() & (F.trim(r) != F.lit("")) & F.col(amount).isNotNull()
    return F.when(ok, F.lit("PENDING")).otherwise(F.lit("INVALID"))


def high_value_notifications(alerts: DataFrame) -> DataFrame:
    """Outbox rows for high-value alerts."""
    return alerts.select(
        "alert_id", "alert_type",
        F.col("customer_email").alias("recipient"),
        F.format_string(K.HIGH_VALUE_SUBJECT_FORMAT, or_missing("alert_id")).alias("subject"),
        render(HIGH_VALUE_BODY).alias("body"),
        _delivery_status("customer_email", "transaction_amount").alias("delivery_status"),
    )


def fraud_card_notifications(alerts: DataFrame) -> DataFrame:
    """Outbox rows for watchlist-match alerts (card masked to its last four)."""
    subject = F.format_string(K.FRAUD_SUBJECT_FORMAT, or_missing("risk_level"), or_missing("alert_id"))
    return alerts.select(
        "alert_id", "alert_type",
        F.col("customer_email").alias("recipient"),
        subject.alias("subject"),
        render(FRAUD_CARD_BODY).alias("body"),
        _delivery_status("customer_email", "amount").alias("delivery_status"),
    )


def masked_cards(alerts: DataFrame) -> DataFrame:
    """alert_id and the masked card of each watchlist-match alert."""
    return alerts.select("alert_id", mask_card("card_number").alias("card_number_masked"))
