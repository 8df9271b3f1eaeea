"""Fraud rules against a brute-force sequential evaluation.

The brute force walks each customer's transactions in (time, id) order with
the full history, as a single-threaded scorer would; the Spark plan splits
customers into time buckets with overlap. Small buckets force many bucket
boundaries, including inside bursts of one hot customer.
"""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vigil import constants as K
from vigil.operators.rules import RULE_COLUMNS, RuleConfig, score_transactions

T0 = datetime(2024, 1, 1)


def make_fixture(seed=7, n=600):
    rnd = random.Random(seed)
    customers = [f"C{i}" for i in range(6)]
    rows, t = [], {c: T0 for c in customers}
    for i in range(n):
        c = "C0" if rnd.random() < 0.45 else rnd.choice(customers)   # one hot customer
        t[c] += timedelta(seconds=rnd.choice([0, 1, 5, 20, 40, 90, 400, 1500, 4000]))
        amount = rnd.choice([3.0, 7.5, 15.0, 19.99, 20.0, 50.0, 150000.0])
        rows.append((f"T{i:05d}", c, f"CARD{c}", f"M{rnd.randint(0, 4)}", amount,
                     rnd.choice(["DEV1", "DEV2", None]), rnd.choice(["Delhi", "London", "Mumbai"]),
                     t[c], rnd.random() < 0.1))
    return rows


def brute_force(rows, cust_dev, merch, cfg: RuleConfig):
    out = {}
    hist: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r[1], r[7], r[0])):
        tid, c, _card, m, amount, dev, city, ts, intl = r
        h = hist.setdefault(c, [])
        prev = h[-1] if h else None
        recent_v = [x for x in h if x[0] >= ts - timedelta(seconds=cfg.velocity_seconds)]
        recent_c = [x for x in h if x[0] >= ts - timedelta(seconds=cfg.card_test_seconds)]
        flags = {
            "rule_high_value": amount > cfg.high_value_amount,
            "rule_impossible_travel": bool(prev and prev[1] == cfg.travel_from and city == cfg.travel_to
                                           and abs((ts - prev[0]).total_seconds()) / 60 <= cfg.travel_max_minutes),
            "rule_new_device": dev != cust_dev.get(c),
            "rule_high_risk_merchant": merch.get(m, (None, None))[0] == "HIGH",
            "rule_blacklisted_merchant": bool(merch.get(m, (None, None))[1]),
            "rule_international": bool(intl),
            "rule_velocity": len(recent_v) >= cfg.velocity_count,
            "rule_card_testing": cfg.card_test_min <= amount <= cfg.card_test_max
            and len(recent_c) >= cfg.card_test_count,
        }
        weights = dict(K.RULE_WEIGHTS)
        fired = [r_ for r_, _ in K.RULE_WEIGHTS if flags[RULE_COLUMNS[r_]]]
        sc = min(100, sum(weights[x] for x in fired))
        reason = fired[0] if fired else "NORMAL"
        dominant = max(fired, key=lambda x: weights[x]) if fired else "NORMAL"   # max keeps the first on ties
        out[tid] = (flags, sc, reason, dominant)
        h.append((ts, city))
    return out


@pytest.mark.parametrize("min_bucket", [0, 3600])
def test_rules_match_sequential_scorer(spark, min_bucket):
    rows = make_fixture()
    cfg = RuleConfig(velocity_count=3, velocity_seconds=120, card_test_count=2, card_test_seconds=300,
                     min_bucket_seconds=min_bucket)
    tx = spark.createDataFrame(rows, "transaction_id string, customer_id string, card_number string, "
                                     "merchant_id string, amount double, device_id string, city string, "
                                     "transaction_timestamp timestamp, is_international boolean")
    cust_dev = {"C0": "DEV1", "C1": "DEV2", "C2": "DEV1"}
    customers = spark.createDataFrame(list(cust_dev.items()), "customer_id string, trusted_device_id string")
    merch = {"M0": ("HIGH", False), "M1": ("LOW", True), "M2": ("MEDIUM", False), "M3": ("LOW", None)}
    merchants = spark.createDataFrame([(k, v[0], v[1]) for k, v in merch.items()],
                                      "merchant_id string, merchant_risk string, is_blacklisted boolean")
    got = {r.transaction_id: r for r in score_transactions(tx, customers, merchants, cfg).collect()}
    want = brute_force(rows, cust_dev, merch, cfg)
    assert set(got) == set(want)
    for tid, (flags, sc, reason, dominant) in want.items():
        g = got[tid]
        for col, v in flags.items():
            assert getattr(g, col) == v, (tid, col)
        assert (g.fraud_score, g.fraud_reason, g.dominant_reason) == (sc, reason, dominant), tid
    assert any(w[0]["rule_velocity"] for w in want.values())
    assert any(w[0]["rule_impossible_travel"] for w in want.values())


def test_dominant_reason_prefers_earlier_rule_on_equal_weight(spark):
    tx = spark.createDataFrame([("T1", "C1", "M0", 10.0, "DEV1", "Mumbai", T0, True)],
                               "transaction_id string, customer_id string, merchant_id string, amount double, "
                               "device_id string, city string, transaction_timestamp timestamp, "
                               "is_international boolean")
    customers = spark.createDataFrame([("C1", "DEV1")], "customer_id string, trusted_device_id string")
    merchants = spark.createDataFrame([("M0", "HIGH", False)],
                                      "merchant_id string, merchant_risk string, is_blacklisted boolean")
    r = score_transactions(tx, customers, merchants).collect()[0]
    assert r.rule_high_risk_merchant and r.rule_international
    assert r.dominant_reason == "HIGH_RISK_MERCHANT" and r.fraud_reason == "HIGH_RISK_MERCHANT"
    assert r.fraud_score == 50


def test_score_is_capped(spark):
    tx = spark.createDataFrame([("T1", "C1", "M0", 200000.0, "DEVX", "Mumbai", T0, True)],
                               "transaction_id string, customer_id string, merchant_id string, amount double, "
                               "device_id string, city string, transaction_timestamp timestamp, "
                               "is_international boolean")
    customers = spark.createDataFrame([("C1", "DEV1")], "customer_id string, trusted_device_id string")
    merchants = spark.createDataFrame([("M0", "HIGH", True)],
                                      "merchant_id string, merchant_risk string, is_blacklisted boolean")
    r = score_transactions(tx, customers, merchants).collect()[0]
    assert r.fraud_score == 100 and r.fraud_reason == "HIGH_VALUE_TRANSACTION"
    assert r.dominant_reason == "BLACKLISTED_MERCHANT"


@settings(max_examples=8, deadline=None)
@given(seed=st.integers(0, 10_000), n=st.integers(5, 150),
       velocity_count=st.integers(1, 6), velocity_seconds=st.sampled_from([10, 60, 600, 3600]),
       card_test_count=st.integers(1, 4), card_test_seconds=st.sampled_from([30, 300, 7200]),
       travel_max_minutes=st.sampled_from([1.0, 20.0, 120.0]), min_bucket=st.sampled_from([0, 60, 3600]))
def test_rules_property_against_sequential_scorer(spark, seed, n, velocity_count, velocity_seconds,
                                                  card_test_count, card_test_seconds, travel_max_minutes,
                                                  min_bucket):
    rows = make_fixture(seed=seed, n=n)
    cfg = RuleConfig(velocity_count=velocity_count, velocity_seconds=velocity_seconds,
                     card_test_count=card_test_count, card_test_seconds=card_test_seconds,
                     travel_max_minutes=travel_max_minutes, min_bucket_seconds=min_bucket)
    tx = spark.createDataFrame(rows, "transaction_id string, customer_id string, card_number string, "
                                     "merchant_id string, amount double, device_id string, city string, "
                                     "transaction_timestamp timestamp, is_international boolean")
    cust_dev = {"C0": "DEV1", "C3": "DEV2"}
    customers = spark.createDataFrame(list(cust_dev.items()), "customer_id string, trusted_device_id string")
    merch = {"M0": ("HIGH", False), "M1": ("LOW", True)}
    merchants = spark.createDataFrame([(k, v[0], v[1]) for k, v in merch.items()],
                                      "merchant_id string, merchant_risk string, is_blacklisted boolean")
    got = {r.transaction_id: (r.fraud_score, r.fraud_reason, r.dominant_reason, r.rule_velocity,
                              r.rule_card_testing, r.rule_impossible_travel)
           for r in score_transactions(tx, customers, merchants, cfg).collect()}
    want = {tid: (sc, reason, dom, f["rule_velocity"], f["rule_card_testing"], f["rule_impossible_travel"])
            for tid, (f, sc, reason, dom) in brute_force(rows, cust_dev, merch, cfg).items()}
    assert got == want
