from vigil.operators import quality as Q

ROWS = [("T1", "C1", "K1", "M1", 10.0), (None, "C2", "K2", "M2", 5.0), ("T3", None, None, "M3", -1.0),
        ("T4", "C4", "K4", "M4", None)]
SCHEMA = "transaction_id string, customer_id string, card_number string, merchant_id string, amount double"


def test_keep_valid_and_quarantine_split_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    kept = sorted(r.transaction_id for r in Q.keep_valid(df).collect())
    assert kept == ["T1", "T4"]             # the warn rule on amount does not drop
    q = {r.transaction_id: r.failed_expectations for r in Q.quarantine(df).collect()}
    assert q == {None: ["valid_transaction_id"], "T3": ["valid_customer_id", "valid_card_number"]}


def test_expectation_report_counts_each_rule(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    rep = {r.expectation: (r.action, r.failed_records, r.total_records)
           for r in Q.expectation_report(df).collect()}
    assert rep["valid_transaction_id"] == ("drop", 1, 4)
    assert rep["valid_customer_id"] == ("drop", 1, 4)
    assert rep["valid_amount"] == ("warn", 2, 4)        # negative and null


def test_observed_metrics_on_batch(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    kept, obs = Q.expect(df, "tx_check")
    assert kept.count() == 2
    m = obs.get
    assert m["valid_transaction_id"] == 1 and m["valid_amount"] == 2 and m["total_records"] == 4


def test_quarantine_messages_keep_raw_text_and_parse_only_rule_fields(spark):
    import json
    good = {"transaction_id": "T1", "customer_id": "C1", "card_number": "K", "merchant_id": "M", "amount": 5.0}
    rows = [("k1", json.dumps(good), "t", 0, 1, None), ("k2", "not json", "t", 0, 2, None),
            ("k3", json.dumps(dict(good, customer_id=None)), "t", 1, 3, None)]
    bronze = spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long, "
                                         "timestamp timestamp")
    q = {r.offset: r for r in Q.quarantine_messages(bronze).collect()}
    assert set(q) == {2, 3}
    assert q[2].value == "not json" and len(q[2].failed_expectations) == 4
    assert q[3].failed_expectations == ["valid_customer_id"]
    plan = Q.quarantine_messages(bronze)._jdf.queryExecution().optimizedPlan().toString()
    parse = [line for line in plan.splitlines() if "from_json" in line][0]
    assert "transaction_id" in parse and "merchant_id" in parse
    assert "StructField(amount" not in parse and "StructField(city" not in parse


def test_quarantine_parses_a_message_once(spark):
    """Before, the filter was moved below the parse and held one for each rule."""
    from pyspark.sql import functions as F
    from vigil.operators import silver as SV

    good = '{"transaction_id":"T1","customer_id":"C1","card_number":"4","merchant_id":"M1","amount":1.0}'
    texts = [good, good.replace('"C1"', "null"), "not json", None, "", "[]", "{}", good.replace('"4"', '{"a":1}'), good[:40], "[" + good + "," + good + "]"]
    bronze = spark.createDataFrame([(str(i), t, "x", 0, i, None) for i, t in enumerate(texts)],
                                   "key string, value string, topic string, partition int, offset long, timestamp timestamp")
    out = Q.quarantine_messages(bronze)
    every = ["valid_transaction_id", "valid_customer_id", "valid_card_number", "valid_merchant_id"]
    got = {r.offset: r.failed_expectations for r in out.collect()}
    kept = {r.kafka_offset for r in Q.keep_valid(SV.parse_transactions(bronze.withColumn("ingestion_timestamp", F.current_timestamp()))).collect()}
    assert got[1] == ["valid_customer_id"] and all(got[i] == every for i in (2, 3, 4, 6)) and 0 not in got
    assert set(got) | kept == set(range(len(texts))) and not set(got) & kept
    assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
