"""Mails rendered for generated alerts: every field, masked cards, escaped text, missing values."""

import html
import re
from datetime import datetime

import pytest

from vigil.functions.columns import mask_card, prefixed_id
from vigil.operators.notify import FRAUD_CARD_BODY, HIGH_VALUE_BODY, fraud_card_notifications, high_value_notifications
from vigil.schemas import FRAUD_CARD_ALERT, HIGH_VALUE_ALERT

KINDS = {"amount": "double", "transaction_amount": "double", "transaction_limit": "double", "is_international": "boolean"}
MAILS = [(FRAUD_CARD_ALERT, FRAUD_CARD_BODY, fraud_card_notifications), (HIGH_VALUE_ALERT, HIGH_VALUE_BODY, high_value_notifications)]


def kind(column):
    return KINDS.get(column) or ("timestamp" if column.endswith(("_timestamp", "_from")) else "string")


def value(column):
    """A value that tells its column."""
    return {"double": 1_000_000.0 + len(column) / 8, "boolean": True, "timestamp": datetime(2031, 1, len(column), 7, 8, 9)}.get(kind(column), f"<{column}>&'\"")


def alert(spark, contract, **own):
    names = [n for n, _ in contract]
    return spark.createDataFrame([tuple(own[n] if n in own else value(n) for n in names)], ", ".join(f"{n} {kind(n)}" for n in names))


def shown(column):
    v = value(column)
    if kind(column) == "double":
        return f"{v:,.2f}"
    return str(v) if kind(column) == "timestamp" else html.escape(v).replace("&#x27;", "&#39;")


@pytest.mark.parametrize("contract, layout, build", MAILS)
def test_each_field_is_shown_once_escaped(spark, contract, layout, build):
    [row] = build(alert(spark, contract, card_number="ABCDEFGHIJKL9876")).collect()
    for field, name in (p for p in layout if not isinstance(p, str)):
        if field in ("text", "money", "ts"):
            assert shown(name) in row.body, name
    unescaped = re.sub(r"</?(html|body|h[23]|p|ul|li|b|br)>", "", row.body)
    assert "<" not in unescaped and ">" not in unescaped
    assert (row.recipient, row.delivery_status) == (value("customer_email"), "PENDING") and value("alert_id") in row.subject


def test_a_card_is_never_shown_whole(spark):
    [row] = fraud_card_notifications(alert(spark, FRAUD_CARD_ALERT, card_number="ABCDEFGHIJKL9876")).collect()
    assert "****9876</li>" in row.body and not re.search("[A-L]{2}9876", row.body)
    assert [r[0] for r in spark.createDataFrame([("ABCDEFGHIJKL9876",), ("76",), ("",), (None,)], "c string").select(mask_card("c")).collect()] == ["9876", "76", "****", "****"]


@pytest.mark.parametrize("contract, layout, build", MAILS)
def test_a_mail_is_written_whatever_is_missing(spark, contract, layout, build):
    [row] = build(alert(spark, contract, **dict.fromkeys(n for n, _ in contract))).collect()
    fields = [p for p in layout if not isinstance(p, str)]
    assert row.body.count("N/A") == sum(p[0] in ("text", "money", "ts") for p in fields) and row.subject.count("N/A") >= 1
    assert row.delivery_status == "INVALID"


@pytest.mark.parametrize("own, status", [({}, "PENDING"), ({"customer_email": " "}, "INVALID"), ({"customer_email": None}, "INVALID"), ({"transaction_amount": None}, "INVALID"),
                                         ({"customer_name": None}, "PENDING")])
def test_what_can_be_delivered(spark, own, status):
    assert high_value_notifications(alert(spark, HIGH_VALUE_ALERT, **own)).first().delivery_status == status


def test_numbered_ids_are_padded_and_never_cut(spark):
    assert tuple(spark.range(1).select(prefixed_id("N", "id", 1), prefixed_id("N", "id", 4)).first()) == ("N0", "N0000")
    assert spark.range(12345, 12346).select(prefixed_id("N", "id", 3)).first()[0] == "N12345"
