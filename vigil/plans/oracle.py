"""Independent SQL (DuckDB dialect) for each registered query.

The domain frames of ``vigil.sources.adapter`` are rebuilt here as common
table expressions over the raw test tables, then each query is written in
plain SQL. Nothing here runs on Spark; it is the reference answer that the
Spark plans are compared with.
"""

from __future__ import annotations

import re

from vigil.operators.rules import RULE_COLUMNS
from vigil.sources import adapter as A


def pad(expr: str, width: int) -> str:
    s = f"CAST({expr} AS VARCHAR)"
    return f"lpad({s}, CAST(greatest({width}, length({s})) AS INTEGER), '0')"


NATION = "(SELECT n_nationkey, n_name FROM nation WHERE n_nationkey >= 0 AND n_nationkey < 25)"

CTE: dict[str, tuple[list[str], str]] = {}


def _cte(name: str, deps: list[str], body: str) -> None:
    CTE[name] = (deps, body)


MERCHANT = "e.event_id % (SELECT coalesce(max(s_suppkey), 0) + 1 FROM supplier)"

_cte("transactions", [], f"""
SELECT
  'TXN' || {pad('e.event_id', 7)} AS transaction_id,
  'CUST' || {pad('e.user_id', 6)} AS customer_id,
  '4' || {pad('e.user_id', 15)} AS card_number,
  'MER' || {pad(MERCHANT, 4)} AS merchant_id,
  s.s_name AS merchant_name,
  e.event_type AS merchant_category,
  e.value AS amount,
  'INR' AS currency,
  CASE WHEN e.event_id % 4 = 0 THEN 'ATM' ELSE 'PURCHASE' END AS transaction_type,
  CASE WHEN e.event_id % 4 = 0 THEN 'ATM' WHEN e.event_id % 4 = 1 THEN 'POS'
       WHEN e.event_id % 4 = 2 THEN 'MOBILE_APP' ELSE 'INTERNET_BANKING' END AS payment_channel,
  CASE WHEN e.event_id % 7 = 0 THEN 'DEV9999' ELSE 'DEV' || {pad('e.user_id', 4)} END AS device_id,
  CASE WHEN e.event_id % 3 = 0 THEN 'Delhi' WHEN e.event_id % 3 = 1 THEN 'London' ELSE 'Mumbai' END AS city,
  n.n_name AS country,
  e.ts AS transaction_timestamp,
  (e.event_id % 15 = 0) AS is_international,
  CASE WHEN e.event_id % 10 = 0 THEN 'DECLINED' ELSE 'APPROVED' END AS status,
  e.event_id AS _eid
FROM events e
LEFT JOIN supplier s ON s.s_suppkey = {MERCHANT}
LEFT JOIN {NATION} n ON n.n_nationkey = e.event_id % 25""")


def _customer_select(key: str, limit: str, date_text: bool = False) -> str:
    open_date = f"CAST(DATE '2020-01-01' + CAST({key} % 1000 AS INTEGER) AS DATE)"
    if date_text:
        open_date = f"strftime({open_date}, '%Y-%m-%d')"
    return f"""
  'CUST' || {pad(key, 6)} AS customer_id,
  'Customer' AS first_name,
  substr(c.c_name, 10) AS last_name,
  CAST(NULL AS VARCHAR) AS gender,
  CAST(NULL AS INTEGER) AS age,
  CAST(NULL AS VARCHAR) AS city,
  CAST(NULL AS VARCHAR) AS state,
  n.n_name AS country,
  CAST(NULL AS DECIMAL(18,2)) AS annual_income,
  c.c_mktsegment AS customer_segment,
  {open_date} AS account_open_date,
  CAST(({key} * 37) % 101 AS INTEGER) AS risk_score,
  CAST(NULL AS DECIMAL(18,2)) AS preferred_spending_min,
  CAST(NULL AS DECIMAL(18,2)) AS preferred_spending_max,
  CAST(NULL AS VARCHAR) AS preferred_city,
  CAST(NULL AS VARCHAR) AS preferred_country,
  'DEV' || {pad(key, 4)} AS trusted_device_id,
  '4' || {pad(key, 15)} AS card_number,
  CAST(NULL AS VARCHAR) AS card_type,
  'c' || CAST({key} AS VARCHAR) || '@example.com' AS email,
  {limit} / 100 AS transaction_limit"""


_cte("customers", [], f"""
SELECT {_customer_select('c.c_custkey', 'c.c_acctbal')}
FROM customer c LEFT JOIN {NATION} n ON n.n_nationkey = c.c_nationkey""")

_cte("customer_log", [], f"""
SELECT {_customer_select('c.c_custkey', 'c.c_acctbal', True)}, TIMESTAMP '{A.SNAPSHOT_TIME}' AS update_timestamp
FROM customer c LEFT JOIN {NATION} n ON n.n_nationkey = c.c_nationkey
UNION ALL
SELECT {_customer_select('c.c_custkey', 'c.c_acctbal * 2', True)}, TIMESTAMP '{A.CHANGE_TIME}' AS update_timestamp
FROM customer c LEFT JOIN {NATION} n ON n.n_nationkey = c.c_nationkey WHERE c.c_mktsegment = 'BUILDING'
UNION ALL
SELECT {_customer_select(f'(c.c_custkey + {A.NEW_CUSTOMER_OFFSET})', 'c.c_acctbal', True)},
       TIMESTAMP '{A.CHANGE_TIME}' AS update_timestamp
FROM customer c LEFT JOIN {NATION} n ON n.n_nationkey = c.c_nationkey WHERE c.c_mktsegment = 'MACHINERY'""")

_cte("watchlist", [], f"""
SELECT
  'WL' || {pad('c.c_custkey', 6)} AS watchlist_id,
  'CARD' AS watch_type,
  '4' || {pad('c.c_custkey', 15)} AS entity_id,
  CASE WHEN c.c_custkey % 3 = 0 THEN 'HIGH' WHEN c.c_custkey % 3 = 1 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
  'ADD' AS action,
  'REPORTED_' || c.c_mktsegment AS reason_code,
  'Card reported, segment ' || c.c_mktsegment AS reason_description,
  CASE WHEN c.c_custkey % 2 = 0 THEN 'active' ELSE 'inactive' END AS status,
  CAST(DATE '2024-01-01' + CAST(c.c_custkey % 30 AS INTEGER) AS TIMESTAMP) AS effective_from,
  'SOC' AS reported_by,
  'Manual' AS reported_source,
  n.n_name AS country,
  CASE WHEN c.c_custkey % 2 = 0 THEN NULL ELSE 'Hyderabad' END AS city,
  c.c_custkey AS _key
FROM customer c LEFT JOIN {NATION} n ON n.n_nationkey = c.c_nationkey
WHERE c.c_acctbal < 0""")

_cte("merchants", [], f"""
SELECT
  'MER' || {pad('s.s_suppkey', 4)} AS merchant_id,
  s.s_name AS merchant_name,
  CAST(NULL AS VARCHAR) AS merchant_category,
  CAST(NULL AS VARCHAR) AS city,
  n.n_name AS country,
  CASE WHEN s.s_suppkey % 10 = 0 THEN 'HIGH' WHEN s.s_suppkey % 4 = 0 THEN 'MEDIUM' ELSE 'LOW' END AS merchant_risk,
  (s.s_suppkey % 10 = 3) AS is_blacklisted
FROM supplier s LEFT JOIN {NATION} n ON n.n_nationkey = s.s_nationkey""")

HV_SELECT = """
  concat_ws('-', 'ALERT', t.transaction_id) AS alert_id,
  'HIGH_VALUE_TRANSACTION' AS alert_type,
  t.transaction_timestamp AS alert_timestamp,
  t.transaction_id, t.customer_id,
  c.email AS customer_email,
  concat_ws(' ', c.first_name, c.last_name) AS customer_name,
  t.amount AS transaction_amount,
  c.transaction_limit,
  t.currency, t.merchant_name, t.merchant_category, t.transaction_type, t.payment_channel,
  t.city, t.country, t.is_international, t.transaction_timestamp, t.status"""

_cte("hv_alerts", ["transactions", "customers"], f"""
SELECT {HV_SELECT}
FROM transactions t JOIN customers c ON t.customer_id = c.customer_id
WHERE t.amount > c.transaction_limit""")

FRAUD_SELECT = """
  concat_ws('-', 'FRAUD', t.transaction_id, w.watchlist_id) AS alert_id,
  'FRAUD_WATCHLIST_MATCH' AS alert_type,
  t.transaction_timestamp AS alert_timestamp,
  t.transaction_id, t.customer_id,
  c.email AS customer_email,
  concat_ws(' ', c.first_name, c.last_name) AS customer_name,
  t.card_number, t.amount, t.currency, t.merchant_id, t.merchant_name, t.merchant_category,
  t.transaction_type, t.payment_channel, t.device_id,
  t.city AS transaction_city, t.country AS transaction_country,
  t.transaction_timestamp, t.is_international,
  t.status AS transaction_status,
  w.watchlist_id, w.watch_type, w.risk_level, w.action, w.reason_code, w.reason_description,
  w.effective_from AS watchlist_effective_from,
  w.reported_by, w.reported_source,
  w.city AS watchlist_city, w.country AS watchlist_country"""

_cte("fraud_alerts", ["transactions", "watchlist", "customers"], f"""
SELECT {FRAUD_SELECT}
FROM transactions t JOIN watchlist w ON t.card_number = w.entity_id
LEFT JOIN customers c ON t.customer_id = c.customer_id""")

_cte("alerts", ["fraud_alerts", "hv_alerts"], """
SELECT alert_id, alert_type, alert_timestamp, customer_name, transaction_status AS status FROM fraud_alerts
UNION ALL
SELECT alert_id, alert_type, alert_timestamp, customer_name, status FROM hv_alerts""")


def with_ctes(body: str, *names: str) -> str:
    """``WITH`` clause holding ``names`` and their dependencies, then ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTE[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({CTE[n][1]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body if parts else body


AS_OF = f"TIMESTAMP '{A.AS_OF}'"

ORACLE: dict[str, str] = {}

ORACLE["high_value_alerts"] = with_ctes("SELECT * FROM hv_alerts", "hv_alerts")
ORACLE["fraud_card_alerts"] = with_ctes("SELECT * FROM fraud_alerts", "fraud_alerts")

_cte("dirty", ["transactions"], """
SELECT _eid,
  CASE WHEN _eid % 97 = 0 THEN NULL ELSE transaction_id END AS transaction_id,
  CASE WHEN _eid % 97 = 0 OR _eid % 50 = 0 THEN NULL ELSE customer_id END AS customer_id,
  CASE WHEN _eid % 97 = 0 OR _eid % 60 = 0 THEN NULL ELSE card_number END AS card_number,
  CASE WHEN _eid % 97 = 0 THEN NULL ELSE merchant_id END AS merchant_id,
  CASE WHEN _eid % 97 = 0 THEN NULL WHEN _eid % 70 = 0 THEN -amount ELSE amount END AS amount
FROM transactions""")

TX_FIELDS = ("transaction_id, customer_id, card_number, merchant_id, merchant_name, merchant_category, amount, "
             "currency, transaction_type, payment_channel, device_id, city, country, transaction_timestamp, "
             "is_international, status")

# ---- ingest / silver
ORACLE["bronze_transactions"] = with_ctes(f"""
SELECT transaction_id AS key, '{A.TOPIC}' AS topic, CAST(_eid % 4 AS INTEGER) AS "partition", _eid AS "offset",
  transaction_timestamp AS "timestamp", 0 AS "timestampType", transaction_id AS value_transaction_id
FROM transactions""", "transactions")

ORACLE["topic_profile"] = with_ctes(f"""
SELECT '{A.TOPIC}' AS topic, CAST(_eid % 4 AS INTEGER) AS "partition", count(*) AS message_count,
  min(_eid) AS first_offset, max(_eid) AS last_offset,
  min(transaction_timestamp) AS first_timestamp, max(transaction_timestamp) AS last_timestamp
FROM transactions GROUP BY 1, 2""", "transactions")

ORACLE["silver_transactions"] = with_ctes(f"""
SELECT {TX_FIELDS}, '{A.TOPIC}' AS kafka_topic, CAST(_eid % 4 AS INTEGER) AS kafka_partition,
  _eid AS kafka_offset, transaction_timestamp AS kafka_timestamp
FROM transactions""", "transactions")

ORACLE["silver_watchlist"] = with_ctes("SELECT * EXCLUDE (_key) FROM watchlist", "watchlist")
ORACLE["silver_customers"] = with_ctes("SELECT * FROM customers", "customers")

_KEYS_PRESENT = ("transaction_id IS NOT NULL AND customer_id IS NOT NULL AND card_number IS NOT NULL "
                 "AND merchant_id IS NOT NULL")
ORACLE["expect_drop_transactions"] = with_ctes(f"""
SELECT transaction_id, customer_id, card_number, merchant_id, amount, _eid AS kafka_offset
FROM dirty WHERE {_KEYS_PRESENT}""", "dirty")

ORACLE["quarantine_transactions"] = with_ctes(f"""
SELECT _eid AS kafka_offset, transaction_id,
  concat_ws(',', CASE WHEN transaction_id IS NULL THEN 'valid_transaction_id' END,
                 CASE WHEN customer_id IS NULL THEN 'valid_customer_id' END,
                 CASE WHEN card_number IS NULL THEN 'valid_card_number' END,
                 CASE WHEN merchant_id IS NULL THEN 'valid_merchant_id' END) AS failed_expectations
FROM dirty WHERE NOT ({_KEYS_PRESENT})""", "dirty")

ORACLE["expectation_report"] = with_ctes("""
SELECT 'valid_transaction_id' AS expectation, 'drop' AS action,
  count(*) FILTER (WHERE transaction_id IS NULL) AS failed_records, count(*) AS total_records FROM dirty
UNION ALL
SELECT 'valid_customer_id', 'drop', count(*) FILTER (WHERE customer_id IS NULL), count(*) FROM dirty
UNION ALL
SELECT 'valid_card_number', 'drop', count(*) FILTER (WHERE card_number IS NULL), count(*) FROM dirty
UNION ALL
SELECT 'valid_merchant_id', 'drop', count(*) FILTER (WHERE merchant_id IS NULL), count(*) FROM dirty
UNION ALL
SELECT 'valid_amount', 'warn', count(*) FILTER (WHERE NOT coalesce(amount > 0, false)), count(*) FROM dirty""",
                                         "dirty")

ORACLE["expect_drop_customers"] = with_ctes(
    "SELECT customer_id, risk_score, transaction_limit FROM customers WHERE customer_id IS NOT NULL", "customers")

# ---- joins
ORACLE["fraud_card_alerts_bounded"] = with_ctes(f"""
SELECT {FRAUD_SELECT}
FROM transactions t JOIN watchlist w ON t.card_number = w.entity_id
  AND t.transaction_timestamp >= w.effective_from
  AND t.transaction_timestamp <= w.effective_from + INTERVAL 7 DAY
LEFT JOIN customers c ON t.customer_id = c.customer_id""", "transactions", "watchlist", "customers")

ORACLE["fraud_card_alerts_snapshot"] = with_ctes(f"""
SELECT {FRAUD_SELECT}
FROM transactions t
JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY watchlist_id ORDER BY effective_from DESC) AS rn
                     FROM watchlist) WHERE rn = 1
        AND lower(status) = 'active' AND coalesce(upper(action), '') <> 'REMOVE') w
  ON t.card_number = w.entity_id
LEFT JOIN customers c ON t.customer_id = c.customer_id""", "transactions", "watchlist", "customers")

ORACLE["unknown_customer_transactions"] = with_ctes("""
SELECT t.transaction_id, t.customer_id, t.amount FROM transactions t
WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE c.customer_id = t.customer_id)""", "transactions", "customers")

# ---- windows
ORACLE["tx_count_tumbling"] = with_ctes("""
SELECT date_trunc('minute', transaction_timestamp) AS window_start,
  date_trunc('minute', transaction_timestamp) + INTERVAL 1 MINUTE AS window_end,
  count(*) AS transaction_count
FROM transactions WHERE transaction_timestamp IS NOT NULL GROUP BY 1, 2""", "transactions")

ORACLE["tx_count_sliding"] = with_ctes("""
SELECT ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end, count(*) AS transaction_count
FROM (SELECT date_trunc('minute', transaction_timestamp) - k * INTERVAL 1 MINUTE AS ws
      FROM (SELECT transaction_timestamp, unnest(range(0, 5)) AS k FROM transactions
            WHERE transaction_timestamp IS NOT NULL))
GROUP BY ws""", "transactions")

# ---- customers
ORACLE["customers_latest"] = with_ctes("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY update_timestamp DESC) AS rn FROM customer_log)
WHERE rn = 1""", "customer_log")

ORACLE["customers_apply_changes"] = with_ctes(f"""
SELECT * EXCLUDE (rn, in_snap, in_chg, src) REPLACE (CAST(account_open_date AS DATE) AS account_open_date),
  CASE WHEN NOT in_snap THEN 'INSERTED' WHEN in_chg THEN 'UPDATED' ELSE 'UNCHANGED' END AS change_type
FROM (
  SELECT *,
    row_number() OVER (PARTITION BY customer_id ORDER BY update_timestamp DESC, src DESC) AS rn,
    bool_or(NOT src) OVER (PARTITION BY customer_id) AS in_snap,
    bool_or(src) OVER (PARTITION BY customer_id) AS in_chg
  FROM (SELECT *, update_timestamp > TIMESTAMP '{A.SNAPSHOT_TIME}' AS src FROM customer_log))
WHERE rn = 1""", "customer_log")

# ---- fraud rules (limits of the test configuration, see catalog._test_rules)
_cte("scored", ["transactions", "customers", "merchants"], """
SELECT t.*, c.trusted_device_id, m.merchant_risk, m.is_blacklisted,
  lag(t.transaction_timestamp, 1) OVER w AS prev_ts,
  lag(t.city, 1) OVER w AS prev_city,
  lag(t.transaction_timestamp, 5) OVER w AS vel_ts,
  lag(t.transaction_timestamp, 3) OVER w AS card_ts
FROM transactions t
LEFT JOIN customers c ON t.customer_id = c.customer_id
LEFT JOIN merchants m ON t.merchant_id = m.merchant_id
WINDOW w AS (PARTITION BY t.customer_id
             ORDER BY t.transaction_timestamp ASC NULLS FIRST, t.transaction_id ASC NULLS FIRST)""")

_cte("flags", ["scored"], """
SELECT transaction_id, customer_id, transaction_timestamp, amount,
  coalesce(amount > 300.0, false) AS rule_high_value,
  coalesce(prev_city = 'Delhi' AND city = 'London'
           AND abs(date_diff('microsecond', prev_ts, transaction_timestamp)) / 60000000.0 <= 1440.0, false)
    AS rule_impossible_travel,
  NOT (device_id IS NOT DISTINCT FROM trusted_device_id) AS rule_new_device,
  coalesce(merchant_risk = 'HIGH', false) AS rule_high_risk_merchant,
  coalesce(is_blacklisted, false) AS rule_blacklisted_merchant,
  coalesce(is_international, false) AS rule_international,
  coalesce(vel_ts >= transaction_timestamp - INTERVAL 172800 SECOND, false) AS rule_velocity,
  coalesce(amount >= 5.0 AND amount <= 20.0 AND card_ts >= transaction_timestamp - INTERVAL 86400 SECOND, false)
    AS rule_card_testing
FROM scored""")

# The rules' weights, written out here so that a wrong weight in the library shows
_WEIGHTS = (
    ("HIGH_VALUE_TRANSACTION", 40),
    ("IMPOSSIBLE_TRAVEL", 50),
    ("NEW_DEVICE", 20),
    ("HIGH_RISK_MERCHANT", 25),
    ("BLACKLISTED_MERCHANT", 60),
    ("INTERNATIONAL_TRANSACTION", 25),
    ("VELOCITY_FRAUD", 45),
    ("CARD_TESTING", 30),
)
_SCORE = "least(100, " + " + ".join(
    f"(CASE WHEN {RULE_COLUMNS[r]} THEN {w} ELSE 0 END)" for r, w in _WEIGHTS) + ")"
_FIRST = "CASE " + " ".join(f"WHEN {RULE_COLUMNS[r]} THEN '{r}'" for r, _ in _WEIGHTS) + " ELSE 'NORMAL' END"
_BY_WEIGHT = sorted(enumerate(_WEIGHTS), key=lambda x: (-x[1][1], x[0]))
_DOMINANT = "CASE " + " ".join(f"WHEN {RULE_COLUMNS[r]} THEN '{r}'" for _, (r, _) in _BY_WEIGHT) + " ELSE 'NORMAL' END"

for _r, _col in RULE_COLUMNS.items():
    ORACLE[_col] = with_ctes(f"""
SELECT transaction_id, customer_id, transaction_timestamp, amount FROM flags WHERE {_col}""", "flags")

ORACLE["fraud_scores"] = with_ctes(f"""
SELECT transaction_id, customer_id, {_SCORE} AS fraud_score, {_FIRST} AS fraud_reason FROM flags""", "flags")
ORACLE["fraud_dominant_reason"] = with_ctes(f"""
SELECT transaction_id, {_SCORE} AS fraud_score, {_DOMINANT} AS dominant_reason FROM flags""", "flags")

# ---- reports (as_of fixed; 'today' written as DATE(ts) = DATE(as_of), as the dashboards do)
_TODAY = f"CAST({{c}} AS DATE) = CAST({AS_OF} AS DATE) AND {{c}} < {AS_OF}"
_WEEK = f"{{c}} >= {AS_OF} - INTERVAL 7 DAY AND {{c}} < {AS_OF}"
_DAY = f"{{c}} >= {AS_OF} - INTERVAL 24 HOUR AND {{c}} < {AS_OF}"
_MONEY_SUM = "CAST(sum(TRY_CAST(amount AS DECIMAL(28,8))) AS DOUBLE)"
_R = {
    "rpt_high_risk_customers": ("SELECT count(*) AS high_risk_count FROM customers WHERE risk_score > 70",
                                "customers"),
    "rpt_transactions_today": (f"SELECT count(*) AS transaction_count FROM transactions WHERE "
                               f"{_TODAY.format(c='transaction_timestamp')}", "transactions"),
    "rpt_avg_amount_today": (f"SELECT {_MONEY_SUM} / nullif(count(amount), 0) AS avg_amount FROM transactions "
                             f"WHERE {_TODAY.format(c='transaction_timestamp')}", "transactions"),
    "rpt_alerts_today": (f"SELECT count(*) AS alert_count FROM alerts WHERE {_TODAY.format(c='alert_timestamp')}",
                         "alerts"),
    "rpt_alert_status": (f"SELECT status, count(*) AS alert_count FROM alerts "
                         f"WHERE {_WEEK.format(c='alert_timestamp')} GROUP BY status", "alerts"),
    "rpt_top_customers": (f"SELECT customer_name, count(*) AS alert_count FROM alerts "
                          f"WHERE {_WEEK.format(c='alert_timestamp')} GROUP BY customer_name "
                          f"ORDER BY alert_count DESC, customer_name ASC NULLS LAST LIMIT 10", "alerts"),
    "rpt_alert_trends": (f"SELECT date_trunc('hour', alert_timestamp) AS alert_hour, count(*) AS alert_count "
                         f"FROM alerts WHERE {_DAY.format(c='alert_timestamp')} GROUP BY 1 ORDER BY 1", "alerts"),
    "rpt_alert_types": (f"SELECT alert_type, count(*) AS alert_count FROM alerts "
                        f"WHERE {_DAY.format(c='alert_timestamp')} GROUP BY alert_type", "alerts"),
    "rpt_volume_by_minute": (f"SELECT date_trunc('minute', transaction_timestamp) AS transaction_minute, "
                             f"count(*) AS transaction_count FROM transactions "
                             f"WHERE {_DAY.format(c='transaction_timestamp')} GROUP BY 1 ORDER BY 1",
                             "transactions"),
    "rpt_intl_vs_domestic": (f"SELECT CASE WHEN is_international = true THEN 'International' ELSE 'Domestic' END "
                             f"AS transaction_type, count(*) AS transaction_count FROM transactions "
                             f"WHERE {_WEEK.format(c='transaction_timestamp')} GROUP BY is_international",
                             "transactions"),
    "rpt_top_merchants": (f"SELECT merchant_name, count(*) AS transaction_count FROM transactions "
                          f"WHERE {_WEEK.format(c='transaction_timestamp')} GROUP BY merchant_name "
                          f"ORDER BY transaction_count DESC, merchant_name ASC NULLS LAST LIMIT 10", "transactions"),
    "rpt_amount_by_category": (f"SELECT merchant_category, {_MONEY_SUM} AS total_amount FROM transactions "
                               f"WHERE {_WEEK.format(c='transaction_timestamp')} GROUP BY merchant_category "
                               f"ORDER BY total_amount DESC", "transactions"),
    "rpt_payment_channels": (f"SELECT payment_channel, count(*) AS transaction_count FROM transactions "
                             f"WHERE {_WEEK.format(c='transaction_timestamp')} GROUP BY payment_channel "
                             f"ORDER BY transaction_count DESC", "transactions"),
    "rpt_by_country": (f"SELECT country, count(*) AS transaction_count, {_MONEY_SUM} AS total_amount "
                       f"FROM transactions WHERE {_WEEK.format(c='transaction_timestamp')} GROUP BY country "
                       f"ORDER BY transaction_count DESC", "transactions"),
    "rpt_watchlist_risk": ("SELECT risk_level, count(*) AS count FROM watchlist WHERE lower(status) = 'active' "
                           "GROUP BY risk_level ORDER BY risk_level", "watchlist"),
    "duplicate_transaction_ids": ("SELECT transaction_id, count(*) AS occurrences FROM transactions "
                                  "GROUP BY transaction_id HAVING count(*) > 1", "transactions"),
}
for _k, (_body, _src) in _R.items():
    ORACLE[_k] = with_ctes(_body, _src)


# ---- notifications: the mails, written out here once more, as SQL
def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _missing(x: str) -> str:
    return f"coalesce(nullif({x}, ''), 'N/A')"


def _esc(x: str) -> str:
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        x = f"replace({x}, {_sq(old)}, {_sq(new)})"
    return x


def _ts_text(x: str) -> str:
    base = f"strftime({x}, '%Y-%m-%d %H:%M:%S')"
    frac = f"lpad(CAST(microsecond({x}) % 1000000 AS VARCHAR), 6, '0')"
    return f"(CASE WHEN {x} IS NULL THEN NULL WHEN microsecond({x}) % 1000000 = 0 THEN {base} " \
           f"ELSE {base} || '.' || {frac} END)"


def _sql_field(kind: str, name: str) -> str:
    if kind == "text":
        return _esc(_missing(name))
    if kind == "money":
        return _missing(f"(CASE WHEN {name} IS NULL THEN NULL ELSE format('{{:,.2f}}', CAST({name} AS DOUBLE)) END)")
    if kind == "ts":
        return _missing(_ts_text(name))
    if kind == "card":
        return _esc(_missing(f"(CASE WHEN {name} IS NULL OR {name} = '' THEN '****' ELSE '****' || right({name}, 4) END)"))
    if kind == "yesno":
        return f"(CASE WHEN coalesce({name}, false) THEN 'Yes' ELSE 'No' END)"
    raise ValueError(kind)


def _mask(name: str) -> str:
    return f"(CASE WHEN {name} IS NULL OR {name} = '' THEN '****' ELSE right({name}, 4) END)"


def _render(template: str) -> str:
    """A mail written with {kind name} for its fields, as SQL."""
    out = []
    for i, part in enumerate(re.split(r"\{(\w+ \w+)\}", template)):
        out.append(_sql_field(*part.split()) if i % 2 else _sq(part))
    return " || ".join(out)


# The two mails as a reader gets them.
_HIGH_VALUE_MAIL = """<html><body>
<h2>High Value Transaction Alert</h2>
<p>Dear {text customer_name},</p>
<p>A transaction exceeded your configured limit.</p>
<ul>
<li><b>Transaction ID:</b> {text transaction_id}</li>
<li><b>Amount:</b> {text currency} {money transaction_amount}</li>
<li><b>Your Limit:</b> {text currency} {money transaction_limit}</li>
<li><b>Merchant:</b> {text merchant_name} ({text merchant_category})</li>
<li><b>Location:</b> {text city}, {text country}</li>
<li><b>Date/Time:</b> {ts transaction_timestamp}</li>
</ul>
<p>If you did not authorize this transaction, contact the fraud department.</p>
<p>Alert ID: {text alert_id}</p>
</body></html>"""

_FRAUD_CARD_MAIL = """<html><body>
<h2>FRAUD ALERT - Suspicious Activity Detected</h2>
<p>Dear {text customer_name},</p>
<p>A transaction on your card matches our fraud watchlist.</p>
<h3>Fraud Details</h3>
<ul>
<li><b>Alert Type:</b> {text alert_type}</li>
<li><b>Risk Level:</b> {text risk_level}</li>
<li><b>Watchlist Type:</b> {text watch_type}</li>
<li><b>Reason:</b> {text reason_description}</li>
<li><b>Action Required:</b> {text action}</li>
</ul>
<h3>Transaction Details</h3>
<ul>
<li><b>Transaction ID:</b> {text transaction_id}</li>
<li><b>Card Number:</b> {card card_number}</li>
<li><b>Amount:</b> {text currency} {money amount}</li>
<li><b>Merchant:</b> {text merchant_name} ({text merchant_category})</li>
<li><b>Transaction Type:</b> {text transaction_type}</li>
<li><b>Payment Channel:</b> {text payment_channel}</li>
<li><b>Location:</b> {text transaction_city}, {text transaction_country}</li>
<li><b>International:</b> {yesno is_international}</li>
<li><b>Date/Time:</b> {ts transaction_timestamp}</li>
<li><b>Status:</b> {text transaction_status}</li>
</ul>
<h3>Watchlist Information</h3>
<ul>
<li><b>Watchlist ID:</b> {text watchlist_id}</li>
<li><b>Reported By:</b> {text reported_by}</li>
<li><b>Reported Source:</b> {text reported_source}</li>
<li><b>Watchlist Location:</b> {text watchlist_city}, {text watchlist_country}</li>
<li><b>Effective From:</b> {ts watchlist_effective_from}</li>
</ul>
<p>Alert ID: {text alert_id}<br>
Alert Timestamp: {ts alert_timestamp}</p>
<p>Never share this message or your card details with anyone.</p>
</body></html>"""


def _status(recipient: str, amount: str) -> str:
    return (f"CASE WHEN {recipient} IS NOT NULL AND trim({recipient}) <> '' AND {amount} IS NOT NULL "
            f"THEN 'PENDING' ELSE 'INVALID' END")


def _notify_oracle() -> None:
    ORACLE["outbox_high_value"] = with_ctes(f"""
SELECT alert_id, alert_type, customer_email AS recipient,
  printf('High Value Transaction Alert - %s', {_missing('alert_id')}) AS subject,
  {_render(_HIGH_VALUE_MAIL)} AS body,
  {_status('customer_email', 'transaction_amount')} AS delivery_status
FROM hv_alerts""", "hv_alerts")
    ORACLE["outbox_fraud_card"] = with_ctes(f"""
SELECT alert_id, alert_type, customer_email AS recipient,
  printf('FRAUD ALERT - %s Risk - %s', {_missing('risk_level')}, {_missing('alert_id')}) AS subject,
  {_render(_FRAUD_CARD_MAIL)} AS body,
  {_status('customer_email', 'amount')} AS delivery_status
FROM fraud_alerts""", "fraud_alerts")
    ORACLE["mask_card"] = with_ctes(f"SELECT alert_id, {_mask('card_number')} AS card_number_masked FROM fraud_alerts",
                                    "fraud_alerts")


_notify_oracle()

# ---- watchlist feed
ORACLE["watchlist_resume"] = with_ctes(f"""
SELECT lower(watchlist_id) AS watchlist_id, entity_id, lower(risk_level) AS risk_level FROM watchlist
WHERE _key > coalesce((SELECT max(_key) FROM watchlist
                       WHERE _key <= {A.WATCHLIST_PUBLISHED_MAX_KEY} AND _key > 0), -1)""", "watchlist")

ORACLE["watchlist_rescued"] = with_ctes("""
SELECT lower(watchlist_id) AS watchlist_id, entity_id,
  CASE WHEN _key % 4 = 0 THEN '{"note":"checked SOC"}' END AS _rescued_data
FROM watchlist""", "watchlist")

# ---- streaming and I/O keys (inputs written as one micro-batch, see vigil.plans.streams)
ORACLE["stream_high_value_alerts"] = ORACLE["high_value_alerts"]
ORACLE["stream_fraud_card_alerts"] = ORACLE["fraud_card_alerts"]
ORACLE["stream_fraud_scores"] = ORACLE["fraud_scores"]
ORACLE["stream_outbox"] = ORACLE["outbox_high_value"]
ORACLE["write_snapshot"] = ORACLE["customers_latest"]

# append mode emits a window once the watermark (max event time in ms - 5 min) reaches its end
_CLOSED = ("window_end <= (SELECT date_trunc('millisecond', max(transaction_timestamp)) FROM transactions) "
           "- INTERVAL 5 MINUTE")
ORACLE["stream_tx_count_tumbling"] = with_ctes(f"""
SELECT * FROM (
SELECT date_trunc('minute', transaction_timestamp) AS window_start,
  date_trunc('minute', transaction_timestamp) + INTERVAL 1 MINUTE AS window_end, count(*) AS transaction_count
FROM transactions WHERE transaction_timestamp IS NOT NULL GROUP BY 1, 2) WHERE {_CLOSED}""", "transactions")
ORACLE["stream_tx_count_sliding"] = with_ctes(f"""
SELECT * FROM (
SELECT ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end, count(*) AS transaction_count
FROM (SELECT date_trunc('minute', transaction_timestamp) - k * INTERVAL 1 MINUTE AS ws
      FROM (SELECT transaction_timestamp, unnest(range(0, 5)) AS k FROM transactions
            WHERE transaction_timestamp IS NOT NULL))
GROUP BY ws) WHERE {_CLOSED}""", "transactions")

_cte("watchlist_file", ["watchlist"], """
SELECT lower(watchlist_id) AS watchlist_id, watch_type, entity_id, lower(risk_level) AS risk_level,
  lower(action) AS action, reason_code, reason_description, status,
  strftime(effective_from, '%d-%b-%Y %H:%M:%S') AS effective_from, reported_by, reported_source, country, city, _key
FROM watchlist""")

ORACLE["bronze_watchlist"] = with_ctes("""
SELECT * EXCLUDE (_key), CASE WHEN _key % 4 = 0 THEN '{"note":"checked SOC"}' END AS _rescued_data,
  true AS has_source_file
FROM watchlist_file""", "watchlist_file")

ORACLE["publish_watchlist_files"] = with_ctes(
    "SELECT * EXCLUDE (_key), CAST(1 AS BIGINT) AS file_records FROM watchlist_file", "watchlist_file")

ORACLE["load_customers_initial"] = with_ctes(
    f"SELECT * FROM customer_log WHERE update_timestamp = TIMESTAMP '{A.SNAPSHOT_TIME}'", "customer_log")

ORACLE["run_available_now"] = with_ctes(f"""
SELECT 'bronze.transactions' AS table_name, count(*) AS row_count FROM dirty
UNION ALL
SELECT 'silver.transactions', count(*) FROM dirty WHERE {_KEYS_PRESENT}
UNION ALL
SELECT 'silver.transactions_quarantine', count(*) FROM dirty WHERE NOT ({_KEYS_PRESENT})
UNION ALL
SELECT 'gold.high_value_transactions_alert', count(*)
FROM (SELECT * FROM dirty WHERE {_KEYS_PRESENT}) t JOIN customers c ON t.customer_id = c.customer_id
WHERE t.amount > c.transaction_limit
UNION ALL
SELECT 'gold.fraud_card_alert', count(*)
FROM (SELECT * FROM dirty WHERE {_KEYS_PRESENT}) t JOIN watchlist w ON t.card_number = w.entity_id""",
                                         "dirty", "customers", "watchlist")

# ---- replayed messages (T12): the last day's messages delivered twice
ORACLE["replayed_duplicate_ids"] = with_ctes(f"""
SELECT transaction_id, CAST(2 AS BIGINT) AS occurrences FROM transactions
WHERE transaction_timestamp >= TIMESTAMP '{A.REPLAY_FROM}'""", "transactions")
ORACLE["dedup_transactions"] = with_ctes(f"SELECT {TX_FIELDS} FROM transactions", "transactions")
ORACLE["stream_customers_upsert"] = ORACLE["customers_latest"]

# ---- CSV and inferred-schema reads
ORACLE["watchlist_csv"] = with_ctes("SELECT * EXCLUDE (_key) FROM watchlist_file", "watchlist_file")
ORACLE["merchants_csv"] = with_ctes("SELECT * FROM merchants", "merchants")
ORACLE["watchlist_inferred_schema"] = with_ctes("""
SELECT * EXCLUDE (_key), CASE WHEN _key % 4 = 0 THEN 'checked SOC' END AS note FROM watchlist_file""",
                                                "watchlist_file")
ORACLE["stream_fraud_scores_tail"] = ORACLE["fraud_scores"]
ORACLE["fraud_card_alerts_salted"] = ORACLE["fraud_card_alerts"]

# ---- incremental customers (S24): new customers are committed half an hour late
ORACLE["stream_customers_incremental"] = with_ctes(f"""
SELECT * REPLACE (CASE WHEN customer_segment = 'MACHINERY' AND update_timestamp = TIMESTAMP '{A.CHANGE_TIME}'
                       THEN update_timestamp - INTERVAL 30 MINUTE ELSE update_timestamp END AS update_timestamp)
FROM customer_log""", "customer_log")
ORACLE["stream_fraud_scores_corrected"] = ORACLE["fraud_scores"]
ORACLE["stream_customers_upsert_buckets"] = ORACLE["customers_latest"]

# ---- stored progress (T-late, P5): the watermark after the first turn is its last event less five minutes;
# bronze keeps what silver drops
ORACLE["late_rows_report"] = with_ctes(f"""
, turns AS (
  SELECT transaction_timestamp AS ts, CAST(substr(transaction_id, 4) AS BIGINT) % 11 = 0 AS late FROM transactions
), mark AS (
  SELECT date_trunc('millisecond', max(ts)) - INTERVAL 5 MINUTE AS ts FROM turns WHERE NOT late AND ts < TIMESTAMP '{A.HALF_TIME}'
)
SELECT query_name, (SELECT count(*) FROM turns) AS input_rows,
  CASE WHEN query_name = 'silver_transactions' THEN (SELECT count(*) FROM turns, mark WHERE late AND turns.ts <= mark.ts) ELSE 0 END AS rows_dropped_by_watermark
FROM (VALUES ('bronze_transactions'), ('silver_transactions'), ('silver_transactions_quarantine')) q(query_name)""", "transactions")
ORACLE["stream_expectation_report"] = ORACLE["expectation_report"]

# ---- growing schema of the watchlist feed (S6, S7): active records come first
ORACLE["watchlist_schema_evolution"] = with_ctes("""
SELECT * EXCLUDE (_key) REPLACE (strptime(effective_from, '%d-%b-%Y %H:%M:%S') AS effective_from),
  CAST(_key AS DOUBLE) + CASE WHEN status = 'active' THEN 0 ELSE 0.25 END AS exposure,
  CASE WHEN status = 'active' THEN CAST(_key AS VARCHAR) ELSE 'T-' || _key END AS ticket,
  CASE WHEN status = 'active' THEN NULL ELSE 'checked SOC' END AS note,
  CASE WHEN status = 'active' THEN 1 ELSE 2 END AS _schema
FROM watchlist_file""", "watchlist_file")
ORACLE["fraud_card_alerts_heavy"] = ORACLE["fraud_card_alerts"]

# ---- limits as of the transaction: the newest row of the customer's changes that isn't later
ORACLE["high_value_alerts_asof"] = with_ctes(f"""
, dated AS (
  SELECT t.*, (SELECT max(l.update_timestamp) FROM customer_log l
               WHERE l.customer_id = t.customer_id AND l.update_timestamp <= t.transaction_timestamp) AS _from
  FROM transactions t
)
SELECT {HV_SELECT} FROM dated t JOIN customer_log c ON c.customer_id = t.customer_id AND c.update_timestamp = t._from
WHERE t.amount > c.transaction_limit""", "transactions", "customer_log")
ORACLE["stream_fraud_card_alerts_bounded"] = ORACLE["fraud_card_alerts_bounded"]
ORACLE["stream_fraud_card_alerts_fresh"] = ORACLE["fraud_card_alerts_snapshot"]

# ---- typed rescue of messages (T4, S8): every 13th amount is text, every 17th message has a field the schema doesn't know
ORACLE["transactions_rescued"] = with_ctes("""
, m AS (SELECT *, CAST(substr(transaction_id, 4) AS BIGINT) AS _eid FROM transactions)
SELECT transaction_id, CASE WHEN _eid % 13 = 0 THEN NULL ELSE amount END AS amount, transaction_timestamp,
  CASE WHEN _eid % 13 = 0 AND _eid % 17 = 0 THEN '{"amount":"' || amount || '","device_risk":{"by":"app","level":' || _eid % 5 || '}}'
       WHEN _eid % 13 = 0 AND amount IS NOT NULL THEN '{"amount":"' || amount || '"}'
       WHEN _eid % 17 = 0 THEN '{"device_risk":{"by":"app","level":' || _eid % 5 || '}}' END AS _rescued_data
FROM m""", "transactions")

ORACLE["stream_quarantine"] = with_ctes("""
SELECT _eid AS kafka_offset,
  concat_ws(',', CASE WHEN transaction_id IS NULL THEN 'valid_transaction_id' END, CASE WHEN customer_id IS NULL THEN 'valid_customer_id' END,
                 CASE WHEN card_number IS NULL THEN 'valid_card_number' END, CASE WHEN merchant_id IS NULL THEN 'valid_merchant_id' END) AS failed_expectations
FROM dirty""", "dirty")
ORACLE["compact_bronze_watchlist"] = ORACLE["bronze_watchlist"]

# ---- delivery (N4): alerts that end in 7 fail once
ORACLE["outbox_delivery"] = with_ctes("""
SELECT alert_type, alert_id, CASE WHEN can THEN 'SENT' ELSE 'INVALID' END AS state,
  CAST(CASE WHEN NOT can THEN 0 WHEN suffix(alert_id, '7') THEN 2 ELSE 1 END AS INTEGER) AS attempts, CAST(NULL AS VARCHAR) AS last_error
FROM (SELECT alert_type, alert_id, bool_or(trim(coalesce(customer_email, '')) <> '' AND transaction_amount IS NOT NULL) AS can FROM hv_alerts GROUP BY 1, 2)""", "hv_alerts")
