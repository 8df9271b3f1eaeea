"""Point-in-time lookup against brute force; salts of heavy cards."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vigil.operators import alerts as AL
from vigil.operators.asof import as_of
from vigil.operators.skew import card_salts, card_sketches

T0 = datetime(2024, 1, 1)
rnd = random.Random(5)


def brute(events, versions):
    out = []
    for e in events:
        held = [(v[1], v) for v in versions if v[0] is not None and v[0] == e[0] and v[1] is not None and e[1] is not None and v[1] <= e[1]]
        out.append((e, max(held)[1] if held else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("kind, bucket", [("timestamp_ntz", 600), ("timestamp", 86_400), ("timestamp", 7)])
def test_as_of_is_the_last_version_before_or_at_the_event(spark, kind, bucket):
    def time():
        return T0 + timedelta(seconds=rnd.choice([0, 1, 600, 1200, rnd.randrange(-20_000, 20_000)]))

    events = [(rnd.choice(["hot", "hot", "hot", "a", "b", "never", None]), rnd.choice([time(), time(), time(), None]), i) for i in range(400)]
    versions = [(rnd.choice(["hot", "a", "b", "unused", None]), rnd.choice([time(), time(), None]), rnd.choice([1.0, 2.0, 3.0])) for _ in range(60)]
    versions += [("a", T0, 1.0), ("a", T0, 5.0), ("a", T0, 2.0)]                       # one time, several rows
    schema = "key string, at {k}, version {t}"
    e = spark.createDataFrame(events, schema.format(k="timestamp", t="int")).withColumn("at", F.col("at").cast(kind)).repartition(4)
    v = spark.createDataFrame(versions, schema.format(k="timestamp", t="double")).withColumnRenamed("version", "limit").repartition(3)
    v = v.withColumn("at", F.col("at").cast(kind))
    e = e.withColumnRenamed("version", "event").withColumn("bucket", F.lit("own"))     # names that the operator uses itself
    out = as_of(e, v, key="key", event_time="at", version_time="at", bucket_seconds=bucket)
    assert out.columns == ["key", "at", "event", "bucket", "version"]
    got = sorted((((r.key, r["at"], r.event), tuple(r.version) if r.version else None) for r in out.collect()), key=repr)
    assert got == brute(events, versions)
    assert as_of(e.limit(0), v, key="key", event_time="at", version_time="at").collect() == []
    assert as_of(e, v.limit(0), key="key", event_time="at", version_time="at").filter("version IS NOT NULL").isEmpty()


def test_as_of_has_no_range_join(spark):
    e = spark.range(10).selectExpr("id % 2 AS key", "timestamp_seconds(id) AS at")
    plan = as_of(e, e.withColumnRenamed("at", "since"), key="key", event_time="at", version_time="since")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "hashpartitioning(key#" in plan


def cards(spark, n=6000):
    """A third of all rows has one card."""
    card = F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("C"), F.col("id") % 997))
    tx = spark.range(n).select(F.concat(F.lit("T"), "id").alias("transaction_id"), card.alias("card_number"), F.timestamp_seconds(F.col("id") * 60 + 1_704_067_200).alias("transaction_timestamp"),
                               (F.col("id") % 9).alias("customer_id"), *[F.lit(None).cast("string").alias(c) for c in (
                                   "currency", "merchant_id", "merchant_name", "merchant_category", "transaction_type", "payment_channel", "device_id", "city", "country", "status")],
                               F.lit(1.0).alias("amount"), F.lit(False).alias("is_international"))
    names = ["watchlist_id", "entity_id", "watch_type", "risk_level", "action", "reason_code", "reason_description", "reported_by", "reported_source", "city", "country", "status"]
    wl = spark.createDataFrame([("W1", "HOT"), ("W2", "HOT"), ("W3", "C5"), ("W4", "none")], "watchlist_id string, entity_id string").select(
        "*", *[F.lit("x").alias(c) for c in names[2:]], F.lit("2024-01-01").cast("timestamp").alias("effective_from"))
    customers = spark.createDataFrame([(1, "e", "f", "l")], "customer_id long, email string, first_name string, last_name string")
    return tx, wl, customers


def test_heavy_cards_are_split_and_alerts_stay_the_same(spark):
    tx, wl, customers = cards(spark)
    sketches = card_sketches(tx.withColumn("day", F.to_date("transaction_timestamp")), "day")
    assert sketches.count() == 5
    salts = card_salts(sketches, spread=64)
    [(card, n)] = salts.collect()
    assert card == "HOT" and 21 <= n <= 23
    plain = AL.fraud_card_alerts(tx, wl, customers, alert_time="transaction_timestamp")
    heavy = AL.fraud_card_alerts(tx, wl, customers, alert_time="transaction_timestamp", salt=salts)
    assert sorted(heavy.collect(), key=repr) == sorted(plain.collect(), key=repr) and heavy.count() == 2 * 2000 + 5
    # dealt by (card, salt) over 8 partitions, the largest has at most three times the median's rows; by card it had more
    t, _, _ = AL._salt(tx, wl, salts)
    def sizes(df, *by):  # noqa: E306
        n = sorted(r["count"] for r in df.repartition(8, *by).groupBy(F.spark_partition_id()).count().collect())
        return n[-1], n[len(n) // 2]
    most, middle = sizes(t, "card_number", "_salt")
    assert most <= 3 * middle
    most, middle = sizes(tx, "card_number")
    assert most > 3 * middle


def test_salts_of_nothing_and_of_even_cards(spark):
    tx, _, _ = cards(spark, 0)
    assert card_salts(card_sketches(tx)).collect() == []
    even = spark.range(1000).select(F.col("id").cast("string").alias("card_number"))
    assert card_salts(card_sketches(even), spread=100).collect() == []
    assert card_salts(card_sketches(even.select(F.lit(None).cast("string").alias("card_number")))).collect() == []
