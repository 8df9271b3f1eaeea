"""A customer holding a third of all rows: split across tasks, results unchanged."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from vigil.operators import alerts
from vigil.operators.rules import RuleConfig, _with_context_buckets, rule_flags

T0 = datetime(2024, 1, 1)


def skewed_transactions(spark, n=3000):
    rows = []
    for i in range(n):
        cust = "HOT" if i % 3 == 0 else f"C{i % 97}"
        rows.append((f"T{i:05d}", cust, "M1", float(i % 500), "DEV1", ["Delhi", "London"][i % 2],
                     T0 + timedelta(seconds=37 * i), False))
    return spark.createDataFrame(rows, "transaction_id string, customer_id string, merchant_id string, "
                                       "amount double, device_id string, city string, "
                                       "transaction_timestamp timestamp, is_international boolean")


def test_hot_customer_is_spread_over_time_buckets(spark):
    tx = skewed_transactions(spark)
    cfg = RuleConfig()
    b = _with_context_buckets(tx, "transaction_timestamp", cfg)
    hot = b.filter("customer_id = 'HOT'")
    assert hot.select("_bucket").distinct().count() >= 20          # one window group per bucket
    assert hot.filter(~F.col("_context")).count() == 1000          # every row once as itself
    customers = spark.createDataFrame([("HOT", "DEV1")], "customer_id string, trusted_device_id string")
    merchants = spark.createDataFrame([("M1", "LOW", False)],
                                      "merchant_id string, merchant_risk string, is_blacklisted boolean")
    flagged = rule_flags(tx, customers, merchants, cfg)
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(customer_id" in plan and "_bucket" in plan and "REPARTITION_BY_COL" in plan
    assert flagged.count() == 3000


def test_skewed_join_partition_is_split_by_adaptive_execution(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        tx = skewed_transactions(spark)
        customers = spark.createDataFrame(
            [("HOT", "a@x", "A", "B", 100.0)] + [(f"C{i}", "c@x", "C", "D", 100.0) for i in range(97)],
            "customer_id string, email string, first_name string, last_name string, transaction_limit double")
        out = alerts.high_value_alerts(tx.withColumn("currency", F.lit("INR"))
                                       .withColumn("merchant_name", F.lit("m"))
                                       .withColumn("merchant_category", F.lit("c"))
                                       .withColumn("transaction_type", F.lit("t"))
                                       .withColumn("payment_channel", F.lit("p"))
                                       .withColumn("country", F.lit("x"))
                                       .withColumn("status", F.lit("s")), customers)
        rows = out.collect()
        assert len(rows) == sum(1 for i in range(3000) if i % 500 > 100)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
