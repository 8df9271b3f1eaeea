"""State of the time-bounded watchlist join, in a session whose own store keeps state on the heap."""

from pyspark.sql import functions as F

from conftest import SF_CHECK
from vigil.operators.skew import card_salts, card_sketches
from vigil.plans.catalog import Domain
from vigil.session import _settings, join_state
from vigil.sources import adapter as A
from vigil.streaming.flows import Layout, Pipeline

STORE = "spark.sql.streaming.stateStore"
ON_HEAP = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
HALF = "2024-01-16"


def test_bounded_join_holds_its_state_on_disk_over_two_runs(spark, workdir):
    layout = Layout(workdir)
    tx = A.transactions(spark, SF_CHECK, ltz=True)
    Domain(spark, SF_CHECK).customers().write.parquet(layout.table("silver", "customers"))
    A.watchlist_messages(spark, SF_CHECK).select("value").write.text(layout.landing("fraud_watchlist"))
    p = Pipeline(spark, layout, alert_time="transaction_timestamp", partition_by_date=False)
    p.bronze_watchlist(layout.landing("fraud_watchlist"))
    p.silver_watchlist()
    open_stores = spark._jvm.org.apache.spark.sql.execution.streaming.state.RocksDBMemoryManager.getNumRocksDBInstances
    with _settings(spark, {f"{STORE}.providerClass": ON_HEAP}):
        for part in (F.col("transaction_timestamp") < HALF, F.col("transaction_timestamp") >= HALF):
            tx.filter(part).write.mode("append").parquet(layout.table("silver", "transactions"))
            q = p.gold_fraud_card(lookback="7 days", salt=p.card_salts())       # the second run goes on from the first one's state
            (op,) = q.lastProgress["stateOperators"]
            assert op["customMetrics"]["rocksdbSstFileSize"] > 0
            assert op["numStateStoreInstances"] == op["numShufflePartitions"]     # not four for each partition
            assert open_stores(True) >= op["numShufflePartitions"]                # those that share one limit
    got = {r.alert_id for r in p.read_table("gold", "fraud_card_alert").collect()}
    want = Domain(spark, SF_CHECK).fraud_alerts().filter(
        "transaction_timestamp >= watchlist_effective_from AND transaction_timestamp <= watchlist_effective_from + INTERVAL 7 DAYS")
    assert got == {r.alert_id for r in want.collect()} and len(got) > 200


def test_join_state_leaves_the_session_as_it_was(spark):
    limit = f"{STORE}.rocksdb.maxMemoryUsageMB"
    names = [f"{STORE}.providerClass", f"{STORE}.rocksdb.changelogCheckpointing.enabled", f"{STORE}.rocksdb.boundedMemoryUsage",
             "spark.sql.streaming.join.stateFormatVersion", limit]
    before = [spark.conf.get(k, None) for k in names]
    with join_state(spark):
        assert spark.conf.get(f"{STORE}.rocksdb.boundedMemoryUsage") == "true"
    assert [spark.conf.get(k, None) for k in names] == before
    with _settings(spark, {limit: "900"}), join_state(spark):                     # the submitter's limit holds
        assert spark.conf.get(limit) == "900"


def test_salts_where_tasks_have_no_sketch(spark):
    cards = spark.createDataFrame([("A", d) for d in range(3) for _ in range(60)] + [(f"B{i}", i % 3) for i in range(60)], "card_number string, day int")
    with _settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        sketches = card_sketches(cards, "day").repartition(20)
        assert [(r.card_number, r.salts) for r in card_salts(sketches, spread=10).collect()] == [("A", 8)]
        assert card_salts(card_sketches(cards.limit(0), "day"), spread=10).collect() == []
