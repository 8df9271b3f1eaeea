"""Domain frames derived from the supplied test tables.

The supplied tables (``events``, ``customer``, ``supplier``, ``nation``) are
mapped onto the card-payment domain; every frame is a plain Spark plan over the
Parquet files, so its work grows with the tables. The DuckDB oracle builds the
same frames in SQL (``vigil.plans.oracle``).

Every event is a transaction; its merchant is spread over the whole key range of
``supplier`` and its country over ``nation``, by left joins. Lookups are
broadcast only by Catalyst's size check. The watchlist lists the customers with
a negative balance; change rows are those of two market segments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


TOPIC = "card_transactions"
AS_OF = "2024-01-30 12:00:00"
SNAPSHOT_TIME = "2024-01-01 00:00:00"
CHANGE_TIME = "2024-01-15 00:00:00"
NEW_CUSTOMER_OFFSET = 10 ** 12          # new customer ids lie above every existing key
WATCHLIST_PUBLISHED_MAX_KEY = 1000      # watchlist records already landed (resume test)
REPLAY_FROM = "2024-01-30 00:00:00"     # messages from here on are delivered twice (replay test)
HALF_TIME = "2024-01-16 00:00:00"        # the second turn of a run in two turns (late-row test) begins here
REPLAY_OFFSET = 10 ** 12                # offsets of the re-delivered copies


_RELATIONS: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The supplied (read-only) table; the resolved relation is reused within
    a session, so its files are listed and its footer read only once."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _RELATIONS.get(key)
    if df is None or df.sparkSession is not spark:
        df = _RELATIONS[key] = spark.read.parquet(path)
    return df


def _nation(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_name") \
        .filter("n_nationkey >= 0 AND n_nationkey < 25")


_MERCHANT_KEYS: dict[tuple[int, str], int] = {}


def _merchant_keys(spark, sf_dir) -> int:
    """Size of the merchants' key range: one number, read once for each folder."""
    key = (id(spark), sf_dir)
    if key not in _MERCHANT_KEYS:
        _MERCHANT_KEYS[key] = (table(spark, sf_dir, "supplier").agg(F.max("s_suppkey")).first()[0] or 0) + 1
    return _MERCHANT_KEYS[key]


def pad(expr: str, width: int) -> str:
    """SQL text: zero-padded number that is never cut (``lpad`` alone truncates)."""
    s = f"CAST({expr} AS STRING)"
    return f"lpad({s}, greatest({width}, length({s})), '0')"


def _sql_id(prefix: str, expr: str, width: int) -> str:
    return f"concat('{prefix}', {pad(expr, width)})"


def transactions(spark: SparkSession, sf_dir: str, ltz: bool = False, with_event_id: bool = False) -> DataFrame:
    """Transactions (16 message fields) from ``events``.

    ``ltz=True`` casts the event time to ``timestamp`` (needed by streaming
    watermarks); batch keys keep ``timestamp_ntz`` as stored.
    ``with_event_id`` keeps the source key as ``_eid`` (message offsets).
    The projection is one list of SQL expressions (a single call into the JVM).
    """
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    n = _nation(spark, sf_dir)
    merchant = f"event_id % {_merchant_keys(spark, sf_dir)}"
    joined = (e.join(s, F.col("s_suppkey") == F.expr(merchant), "left")
              .join(n, F.col("n_nationkey") == F.col("event_id") % 25, "left"))
    exprs = [
        f"{_sql_id('TXN', 'event_id', 7)} AS transaction_id",
        f"{_sql_id('CUST', 'user_id', 6)} AS customer_id",
        f"{_sql_id('4', 'user_id', 15)} AS card_number",
        f"{_sql_id('MER', merchant, 4)} AS merchant_id",
        "s_name AS merchant_name",
        "event_type AS merchant_category",
        "value AS amount",
        "'INR' AS currency",
        "CASE WHEN event_id % 4 = 0 THEN 'ATM' ELSE 'PURCHASE' END AS transaction_type",
        "CASE WHEN event_id % 4 = 0 THEN 'ATM' WHEN event_id % 4 = 1 THEN 'POS' "
        "WHEN event_id % 4 = 2 THEN 'MOBILE_APP' ELSE 'INTERNET_BANKING' END AS payment_channel",
        f"CASE WHEN event_id % 7 = 0 THEN 'DEV9999' ELSE {_sql_id('DEV', 'user_id', 4)} END AS device_id",
        "CASE WHEN event_id % 3 = 0 THEN 'Delhi' WHEN event_id % 3 = 1 THEN 'London' ELSE 'Mumbai' END AS city",
        "n_name AS country",
        ("CAST(ts AS TIMESTAMP)" if ltz else "ts") + " AS transaction_timestamp",
        "(event_id % 15 = 0) AS is_international",
        "CASE WHEN event_id % 10 = 0 THEN 'DECLINED' ELSE 'APPROVED' END AS status",
    ]
    if with_event_id:
        exprs.append("event_id AS _eid")
    return joined.selectExpr(*exprs)


def _json_value(tx: DataFrame) -> Column:
    """The message text as the producer sends it (ISO time with ``Z``)."""
    fields = [F.col(c) for c in tx.columns if c != "transaction_timestamp"]
    ts_text = F.concat(F.date_format("transaction_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    return F.to_json(F.struct(*fields[:13], ts_text.alias("transaction_timestamp"), *fields[13:]))


def kafka_messages(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """Frame with the Kafka source schema carrying one message per transaction.

    ``dirty=True`` injects the bad input the silver expectations must catch:
    null customer_id (event_id % 50 = 0), null card (% 60 = 0), negative
    amount (% 70 = 0) and non-JSON text (% 97 = 0).
    """
    tx = transactions(spark, sf_dir, with_event_id=True)
    if dirty:
        eid = F.col("_eid")
        tx = (tx.withColumn("customer_id", F.when(eid % 50 == 0, F.lit(None)).otherwise(F.col("customer_id")))
                .withColumn("card_number", F.when(eid % 60 == 0, F.lit(None)).otherwise(F.col("card_number")))
                .withColumn("amount", F.when(eid % 70 == 0, -F.col("amount")).otherwise(F.col("amount"))))
    value = _json_value(tx.drop("_eid"))
    if dirty:
        value = F.when(F.col("_eid") % 97 == 0, F.lit("not json")).otherwise(value)
    return tx.select(
        F.col("transaction_id").alias("key"),
        value.alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("_eid") % 4).cast("int").alias("partition"),
        F.col("_eid").alias("offset"),
        F.col("transaction_timestamp").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def _customer_exprs(key: str, limit: str) -> list[str]:
    """SQL expressions of the 21 customer columns from a ``customer`` row."""
    return [
        f"{_sql_id('CUST', key, 6)} AS customer_id",
        "'Customer' AS first_name",
        "substring(c_name, 10) AS last_name",
        "CAST(NULL AS STRING) AS gender",
        "CAST(NULL AS INT) AS age",
        "CAST(NULL AS STRING) AS city",
        "CAST(NULL AS STRING) AS state",
        "n_name AS country",
        "CAST(NULL AS DECIMAL(18,2)) AS annual_income",
        "c_mktsegment AS customer_segment",
        f"date_format(date_add(DATE'2020-01-01', CAST({key} % 1000 AS INT)), 'yyyy-MM-dd') AS account_open_date",
        f"CAST(({key} * 37) % 101 AS INT) AS risk_score",
        "CAST(NULL AS DECIMAL(18,2)) AS preferred_spending_min",
        "CAST(NULL AS DECIMAL(18,2)) AS preferred_spending_max",
        "CAST(NULL AS STRING) AS preferred_city",
        "CAST(NULL AS STRING) AS preferred_country",
        f"{_sql_id('DEV', key, 4)} AS trusted_device_id",
        f"{_sql_id('4', key, 15)} AS card_number",
        "CAST(NULL AS STRING) AS card_type",
        f"concat('c', CAST({key} AS STRING), '@example.com') AS email",
        f"{limit} / 100 AS transaction_limit",
    ]


def _customers_with_nation(spark, sf_dir, columns=("c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                                      "c_mktsegment")) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(*columns)
    return c.join(_nation(spark, sf_dir), F.col("n_nationkey") == F.col("c_nationkey"), "left")


def customers_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze customers: source columns plus ``update_timestamp`` (initial snapshot)."""
    return _customers_with_nation(spark, sf_dir).selectExpr(
        *_customer_exprs("c_custkey", "c_acctbal"),
        f"TIMESTAMP_NTZ'{SNAPSHOT_TIME}' AS update_timestamp")


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows after the snapshot: customers of segment BUILDING again with the limit
    doubled, and new customers (from segment MACHINERY) with ids above every existing key."""
    j = _customers_with_nation(spark, sf_dir)
    changed_at = f"TIMESTAMP_NTZ'{CHANGE_TIME}' AS update_timestamp"
    updated = j.filter("c_mktsegment = 'BUILDING'").selectExpr(*_customer_exprs("c_custkey", "c_acctbal * 2"), changed_at)
    new = j.filter("c_mktsegment = 'MACHINERY'").selectExpr(
        *_customer_exprs(f"(c_custkey + {NEW_CUSTOMER_OFFSET})", "c_acctbal"), changed_at)
    return updated.unionByName(new)


def watchlist_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watchlist file records (all text, as landed): one per listed card."""
    j = _customers_with_nation(spark, sf_dir, ("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")) \
        .filter("c_acctbal < 0")
    return j.selectExpr(
        f"{_sql_id('wl', 'c_custkey', 6)} AS watchlist_id",
        "'CARD' AS watch_type",
        f"{_sql_id('4', 'c_custkey', 15)} AS entity_id",
        "CASE WHEN c_custkey % 3 = 0 THEN 'high' WHEN c_custkey % 3 = 1 THEN 'medium' ELSE 'low' END AS risk_level",
        "'add' AS action",
        "concat('REPORTED_', c_mktsegment) AS reason_code",
        "concat('Card reported, segment ', c_mktsegment) AS reason_description",
        "CASE WHEN c_custkey % 2 = 0 THEN 'active' ELSE 'inactive' END AS status",
        "date_format(CAST(date_add(DATE'2024-01-01', CAST(c_custkey % 30 AS INT)) AS TIMESTAMP_NTZ), "
        "'dd-MMM-yyyy HH:mm:ss') AS effective_from",
        "'SOC' AS reported_by",
        "'Manual' AS reported_source",
        "n_name AS country",
        "CASE WHEN c_custkey % 2 = 0 THEN CAST(NULL AS STRING) ELSE 'Hyderabad' END AS city",
    )


def watchlist_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watchlist records as JSON text lines; every 4th listed key carries an
    unknown field ``note`` that the schema does not know (rescued data)."""
    w = watchlist_records(spark, sf_dir)
    k = F.regexp_extract("watchlist_id", r"(\d+)$", 1).cast("long")
    note = F.when(k % 4 == 0, F.concat(F.lit("checked "), F.col("reported_by")))
    return w.select(F.to_json(F.struct(*[F.col(c) for c in w.columns], note.alias("note"))).alias("value"),
                    F.concat(F.lit("watchlist/"), F.col("watchlist_id"), F.lit(".json")).alias("file_path"))


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    j = s.join(_nation(spark, sf_dir), F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return j.selectExpr(
        f"{_sql_id('MER', 's_suppkey', 4)} AS merchant_id",
        "s_name AS merchant_name",
        "CAST(NULL AS STRING) AS merchant_category",
        "CAST(NULL AS STRING) AS city",
        "n_name AS country",
        "CASE WHEN s_suppkey % 10 = 0 THEN 'HIGH' WHEN s_suppkey % 4 = 0 THEN 'MEDIUM' ELSE 'LOW' END AS merchant_risk",
        "(s_suppkey % 10 = 3) AS is_blacklisted",
    )
